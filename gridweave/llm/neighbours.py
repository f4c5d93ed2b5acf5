"""Nearest vectors by inner product: collision-counting hashing over sorted single projections.

Rows are dealt to blocks of some `BLOCK` rows. A block is indexed whole: each vector gets one more component that gives all
vectors of the block the length of the longest, so the largest inner product is the smallest distance; the vectors are
projected on `PROJECTIONS` random lines, and each line keeps its sorted array of places. Nothing is cut into fixed buckets:
a query opens a window around its own place in every array and widens all of them step by step (virtual rehashing); a
vector collides once for each window it is in. Vectors with `COLLISIONS` collisions or more are verified by their true
inner product. A query is done when its windows are so wide that a vector as near as the k-th best found would have been
verified with probability `CERTAIN`; windows that hold the whole block end it as well.

A stated set of queries meets all rows in blocks: queries are dealt to parts, and a part meets a block in one task that keeps
the block's index and streams the queries. Both sides of a meeting are bounded, whatever the table holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridweave.llm.common import table
from gridweave.session import stage

NEAREST, EVERY = 20, 20
BLOCK, ASKERS = 1 << 14, 1 << 10
PROJECTIONS, COLLISIONS, CERTAIN = 48, 27, 0.97
#: Windows start at this share of the longest vector, or of the last query's windows if they were wider, and widen by this factor.
FIRST, START, WIDER = 0.1, 0.9, 1.1


@cache
def reach() -> float:
    """Half a window in units of a distance at which a vector collides `COLLISIONS` times with probability `CERTAIN`."""
    def seen(p: float) -> float:
        return sum(math.comb(PROJECTIONS, k) * p**k * (1 - p) ** (PROJECTIONS - k) for k in range(COLLISIONS, PROJECTIONS + 1))

    low, high = 0.0, 10.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if seen(math.erf(middle / math.sqrt(2))) >= CERTAIN else (middle, high)
    return high


class Block:
    """The index of some vectors of one dimension."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.vectors, self.ids, self.rows = vectors, ids, rows
        n, size = vectors.shape
        scaled = vectors / np.abs(vectors).max()
        squares = (scaled * scaled).sum(axis=1)
        self.scaled, self.longest = scaled.astype(np.float32), math.sqrt(squares.max())
        self.usual = FIRST * self.longest
        self.lines = np.random.Generator(np.random.Philox(size)).standard_normal((PROJECTIONS, size + 1))
        places = self.lines[:, :size] @ scaled.T + self.lines[:, size:] * np.sqrt(np.maximum(squares.max() - squares, 0))
        order = np.argsort(places, axis=1, kind="stable")
        # All arrays in one, each moved past the one before, so that one search finds the windows of all.
        bound = np.abs(places).max() + 1
        self.apart = 4 * bound * np.arange(PROJECTIONS)
        self.bound = bound
        self.sorted = (np.take_along_axis(places, order, axis=1) + self.apart[:, None]).ravel()
        self.order = order.astype(np.uint16 if n <= 1 << 16 else np.uint32).ravel()

    def nearest(self, query: np.ndarray, own: int, k: int) -> np.ndarray:
        """Places in the block of the k nearest vectors found, and of any about as near as the last; not the row `own`."""
        n = len(self.rows)
        query = query / np.abs(query).max()
        query = query / math.sqrt((query * query).sum())
        centre = self.lines[:, :-1] @ query * self.longest
        rough = query.astype(np.float32)
        open_ = self.rows != own
        counts, found, products = np.zeros(n, np.int64), [], []
        first = last = np.searchsorted(self.sorted, np.clip(centre, -self.bound, self.bound) + self.apart)
        best, wanted, half = np.zeros(0, np.float32), min(k, int(open_.sum())), self.usual
        while wanted:
            edges = np.clip(np.stack((centre - half, centre + half)), -1.5 * self.bound, 1.5 * self.bound) + self.apart
            left = np.minimum(np.searchsorted(self.sorted, edges[0], "left"), first)
            right = np.maximum(np.searchsorted(self.sorted, edges[1], "right"), last)
            bounds = (*zip(left.tolist(), first.tolist(), strict=True), *zip(last.tolist(), right.tolist(), strict=True))
            counts += np.bincount(np.concatenate([self.order[a:b] for a, b in bounds if a < b] or [self.order[:0]]), minlength=n)
            first, last = left, right
            new = np.flatnonzero((counts >= COLLISIONS) & open_)
            if len(new):
                open_[new] = False
                found.append(new)
                products.append(self.scaled[new] @ rough)
                best = np.concatenate((best, products[-1]))
                if len(best) > wanted:
                    best = np.partition(best, len(best) - wanted)[-wanted:]
            if int((last - first).sum()) == n * PROJECTIONS:
                break
            target = math.inf
            if len(best) == wanted:
                # The distance of a vector as near as the k-th best, from the query at the length of the longest vector.
                target = reach() * math.sqrt(max(2 * self.longest * (self.longest - float(best.min())), 0))
                if half >= target:
                    break
            half = min(half * WIDER, max(target, half * 1.001))
        if not found:
            return np.zeros(0, np.int64)
        self.usual = max(START * half, FIRST * self.longest)
        places, products = np.concatenate(found), np.concatenate(products)
        # Products of single precision choose generously; the exact ones decide.
        return places[products >= best.min() - 1e-5 * self.longest]


def takes_part(vector: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, block: int = BLOCK, askers: int = ASKERS) -> DataFrame:
    """The k rows nearest to each row of `vectors` that `is_query` holds for: `query_id, rank, vec_id, score`.

    Takes the columns `vec_id` (a whole number) and `embedding` (an array of numbers); others are not looked at. Nearness is
    the inner product in double precision; nearest first, ties to the smaller `vec_id`, a null one last. A query's own row is no
    candidate; other rows with the same `vec_id` are, and a repeated query row is a query by itself, with equal `query_id`.
    Vectors that are null, zero or hold a null or non-finite component take no part. Vectors of different sizes never meet.
    Products that overflow to no number come last. With fewer than k candidates all come out; an empty table, or one
    without queries, gives no rows. All rows are indexed; recall is that of the probability `CERTAIN` or better.
    """
    import pyarrow as pa

    rows = stage(vectors.where(takes_part(F.col("embedding"))).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "embedding",
        F.coalesce(is_query, F.lit(False)).alias("asks")), "vectors")
    n, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, parts = max(1, -(-n // block)), max(1, -(-asking // askers))
    values = ["row", "vec_id", "embedding"]
    kept = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), F.lit(False).alias("asks"), *values)
    asked = rows.where("asks").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(parts)).alias("part"), F.lit(True).alias("asks"), *values)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        index: dict[int, Block] = {}
        meeting = None
        for batch in batches:
            found: list[list] = [[], [], [], []]
            for at, part, asks, row, vec_id, vector in zip(*[batch.column(i).to_pylist() for i in range(5)], batch.column(5), strict=True):
                vector = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if (at, part) != meeting:
                    meeting, held, index = (at, part), {}, {}
                if not asks:
                    held.setdefault(len(vector), []).append((row, vec_id, vector))
                    continue
                size = len(vector)
                if size not in index and size in held:
                    its_rows, ids, its_vectors = zip(*held.pop(size), strict=True)
                    index[size] = Block(np.stack(its_vectors), np.array(ids, object), np.array(its_rows))
                if size in index:
                    near = index[size]
                    which = near.nearest(vector, row, k)
                    with np.errstate(over="ignore", invalid="ignore"):
                        scores = (near.vectors[which] * vector).sum(axis=1)
                    for column, more in zip(found, ([row] * len(which), [vec_id] * len(which), near.ids[which], scores), strict=True):
                        column.extend(more)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds, strict=True)], ["asker", "query_id", "vec_id", "score"])

    meetings = kept.unionByName(asked).repartition(blocks * parts, "block", "part").sortWithinPartitions("block", "part", "asks")
    pairs = meetings.mapInArrow(search, "asker long, query_id long, vec_id long, score double")
    best = Window.partitionBy("asker").orderBy(F.isnan("score"), F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of each row of `embeddings` whose `vec_id` is divisible by 20, among all other rows."""
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % EVERY == 0)


QUERIES = {"op11_neighbours": op11_neighbours}
#: Which near vectors are found depends on random lines; tests measure recall against all pairs.
ORACLES: dict[str, str] = {}
