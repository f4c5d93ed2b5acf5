"""Isolation forest (Liu, Ting, Zhou 2008): trees grown in parallel on repeatable row samples."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.models import scoring
from gridweave.operators import prepare, series
from gridweave.session import stage

TREES, SAMPLE, SEED = 200, 256, 42
MINIMUM_ROWS = 8
NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, path double"


def expected_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    return np.where(n > 2, 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big, np.where(n == 2, 1.0, 0.0))


def tree_samples(df: DataFrame, features: list[str], rows: int, *, trees: int, sample: int, seed: int) -> DataFrame:
    """At most `sample` rows per tree, those with the lowest hash of (row, tree).

    One rule for tables of any size: a row serves each tree whose hash with the row is below a bound that falls with the
    number of rows. The trees are found inside the row, so only what is drawn becomes rows. Copies of a row are numbered and drawn
    each by itself; which copy has which number makes no difference, so the sample does not depend on how rows are dealt.
    """
    hashed = df.select(F.xxhash64(*df.columns, F.lit(seed)).alias("__row"), scoring.feature_array(df, features).alias("x"))
    numbered = series.series_index(stage(hashed, "features"), ["__row"], [], name="__copy")
    base = numbered.select(F.when(F.col("__copy") == 0, F.col("__row")).otherwise(F.xxhash64("__row", "__copy")).alias("__row"), "x")
    keep = 1.5 * sample  # so that a tree ends up short only with negligible probability
    cut = 2.0**63 * min(1.0, keep / max(rows, 1))
    served = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: F.abs(F.xxhash64("__row", tree).cast("double")) <= cut)
    drawn = base.withColumn("tree", F.explode(served)).withColumn("__draw", F.xxhash64("__row", "tree"))
    lowest = Window.partitionBy("tree").orderBy("__draw")
    return drawn.withColumn("__rank", F.row_number().over(lowest)).where(F.col("__rank") <= sample).select("tree", "__rank", "x")


def grow_trees(samples: DataFrame, *, trees: int, sample: int, seed: int) -> DataFrame:
    """One small tree per group of at most `sample` rows, as a table of nodes."""
    depth_limit = int(np.ceil(np.log2(max(sample, 2))))

    def grow(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        points = np.stack(frame.sort_values("__rank")["x"].to_numpy())
        rng = np.random.default_rng([seed, tree])
        nodes, pending = [], [(0, np.arange(len(points)), 0)]
        following = 1
        while pending:
            node, members, depth = pending.pop()
            held = points[members]
            low, high = held.min(axis=0), held.max(axis=0)
            splittable = np.flatnonzero(high > low)
            if depth >= depth_limit or len(splittable) == 0:
                nodes.append((tree, node, -1, 0.0, -1, -1, depth + float(expected_path(len(members)))))
                continue
            feature = int(rng.choice(splittable))
            cut = float(rng.uniform(low[feature], high[feature]))
            goes_left = held[:, feature] <= cut
            nodes.append((tree, node, feature, cut, following, following + 1, 0.0))
            pending += [(following, members[goes_left], depth + 1), (following + 1, members[~goes_left], depth + 1)]
            following += 2
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "path"])

    # The samples are small in bytes but not in work: keep Spark from joining all trees into one task.
    tasks = min(trees, 2 * samples.sparkSession.sparkContext.defaultParallelism)
    return samples.repartition(tasks, "tree").groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


@dataclass
class IsolationForest:
    features: list[str]
    nodes: pd.DataFrame  # at most trees * (2 * sample - 1) rows, whatever the table size
    sample: int
    threshold: float = 0.0

    def scores(self, df: DataFrame) -> DataFrame:
        """Add `anomaly_score` = -2^(-mean path / expected path); lower is stranger."""
        trees = [t.sort_values("node").reset_index(drop=True) for _, t in self.nodes.groupby("tree", sort=True)]
        packed = [tuple(t[c].to_numpy() for c in ("feature", "cut", "left", "right", "path")) for t in trees]
        shared = df.sparkSession.sparkContext.broadcast((packed, float(expected_path(self.sample))))

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            forest, norm = shared.value
            if x.empty:
                return pd.Series([], dtype=float)
            points = np.stack(x.to_numpy())
            rows = np.arange(len(points))
            total = np.zeros(len(points))
            for feature, cut, left, right, path in forest:
                at = np.zeros(len(points), dtype=int)
                while (inner := feature[at] >= 0).any():
                    lefts = points[rows, np.maximum(feature[at], 0)] <= cut[at]
                    at = np.where(inner, np.where(lefts, left[at], right[at]), at)
                total += path[at]
            return pd.Series(-np.exp2(-total / len(forest) / norm))

        return df.withColumn("anomaly_score", score(scoring.feature_array(df, self.features)))

    def score(self, df: DataFrame) -> DataFrame:
        return scoring.flag(self.scores(df), self.threshold, scoring.BELOW)

    def save(self, spark, path: str) -> None:
        spark.createDataFrame(self.nodes).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        scoring.save_metadata(spark, path, {
            "features": self.features, "sample": self.sample, "threshold": self.threshold, "direction": scoring.BELOW,
        })

    @classmethod
    def load(cls, spark, path: str) -> IsolationForest:
        meta = scoring.load_metadata(spark, path)
        return cls(list(meta["features"]), spark.read.parquet(f"{path}/nodes").toPandas(), meta["sample"], meta["threshold"])


def train_isolation(
    gold: DataFrame, *, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED, spread: bool | None = None
) -> tuple[IsolationForest, DataFrame]:
    """Fit on (a repeated tiny or) the whole table; flag below the 5th percentile of its scores."""
    prepare.require_rows(gold)
    features = prepare.numeric_columns(gold, schemas.ISOLATION_EXCLUDED)
    rows = gold.count()
    training = prepare.repeat_to_minimum(gold, MINIMUM_ROWS, [schemas.EVENT_TIME])
    rows_used = max(rows, MINIMUM_ROWS)
    samples = tree_samples(training, features, rows_used, trees=trees, sample=sample, seed=seed)
    nodes = grow_trees(samples, trees=trees, sample=sample, seed=seed).toPandas()
    forest = IsolationForest(features, nodes, min(sample, rows_used))
    forest.threshold, flagged = scoring.fit_threshold(forest.scores(gold), 0.05, scoring.BELOW, row_bound=rows, spread=spread)
    metrics = scoring.anomaly_metrics(
        flagged, forest.threshold, algorithm="isolation_forest",
        bootstrap_rows=scoring.bootstrap_rows(MINIMUM_ROWS), features=features,
    )
    return forest, metrics
