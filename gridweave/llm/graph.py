"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.session import stage


def components(edges: DataFrame) -> DataFrame:
    """Undirected edges `a, b` (numbers) -> `node, component`, the smallest node that can be reached.

    Large-star and small-star steps in turn: each hangs nodes on the smallest neighbour they know, until nothing changes; the
    number of rounds grows with the logarithm of the longest path. Each round is written, minima are combined before
    the shuffle, and a node with very many neighbours is only a join key that Spark can split.
    """
    links = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        # Large star: larger neighbours of a node hang on the smallest neighbour (or the node itself).
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stage(large.where("a > b").distinct(), "links")
        # Small star: smaller neighbours of a node, and the node, hang on the smallest of them.
        down = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(down, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = stage(small.unionByName(down.select("a", F.col("least").alias("b"))).distinct(), "links")
        changed = small.join(links, ["a", "b"], "left_anti").limit(1).count() or links.join(small, ["a", "b"], "left_anti").limit(1).count()
        links = small
        if not changed:
            roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
