"""Frames over a span of time on dense series, where one frame may hold more rows than a task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridweave.operators import series as rows_of
from gridweave.operators import sizing
from gridweave.operators.asof import as_of_join
from gridweave.session import stage

CHUNK_ROWS = rows_of.CHUNK_ROWS


def prefix_sums(indexed: DataFrame, series: Sequence[str], columns: Sequence[str], *, index: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add `__upto_<column>` and `__seen_<column>`: sum and count of a column's values up to each row of its series.

    `index` is the 0-based position. Chunks of the series are summed in parallel; the sums of earlier chunks are a row each.
    """
    series = list(series)
    chunked = indexed.withColumn("__chunk", F.floor(F.col(index) / chunk_rows))
    inside = Window.partitionBy(*series, "__chunk").orderBy(index).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = chunked.groupBy(*series, "__chunk").agg(*[f for c in columns for f in (F.sum(c).alias(f"__sum_{c}"), F.count(c).alias(f"__n_{c}"))])
    before = Window.partitionBy(*series).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select(
        *[F.col(k).alias(f"__of_{k}") for k in [*series, "__chunk"]],
        *[F.coalesce(F.sum(f"__{kind}_{c}").over(before), F.lit(0)).alias(f"__{kind}_{c}") for c in columns for kind in ("sum", "n")])
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in [*series, "__chunk"]]
    added = [x for c in columns for x in (
        (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__sum_{c}")).alias(f"__upto_{c}"), (F.count(c).over(inside) + F.col(f"__n_{c}")).alias(f"__seen_{c}"))]
    return chunked.join(earlier, same).select(*indexed.columns, *added)


def dense_time_windows(
    df: DataFrame, series: Sequence[str], time: str, columns: Sequence[str], *, seconds: int, chunk_rows: int = CHUNK_ROWS, spread: bool | None = None
) -> DataFrame:
    """Add `<column>_sum`, `_count`, `_min` and `_max` over the last `seconds` of time, rows of the same time included.

    Equal to a range window, but no frame is gathered. Rows of a series with the same time share a frame, so they are combined into a
    moment first (map-side), and all that follows moves moments: the first moment of each frame is found by a point-in-time
    join over the sorted series, the last is the moment itself; sums and counts are differences of prefix sums; extremes come from blocks of
    about the square root of the longest frame: the rest of the first block, the blocks between, the beginning of the last. At the end each row
    looks up its moment. Rows without a time have no frame and get nulls. Sums of fractions differ from a window's by rounding.
    """
    series, columns = list(series), list(columns)
    # A series without a name is one, too, but joins know no null keys.
    rows = stage(df.withColumn("__series", F.xxhash64(F.struct(*series)) if series else F.lit(0)).withColumn("__at", F.unix_micros(F.col(time).cast("timestamp"))), "frame-rows")
    extremes = (("min", F.min, F.least), ("max", F.max, F.greatest))
    moments = stage(rows.where("__at IS NOT NULL").groupBy("__series", "__at").agg(
        *[x for c in columns for x in (F.sum(c).alias(f"__sum_{c}"), F.count(c).alias(f"__count_{c}"), *[f(c).alias(f"__{n}_{c}") for n, f, _ in extremes])]), "moments")
    indexed = rows_of.series_index(moments, ["__series"], ["__at"], name="__idx", spread=spread)
    added = [f"__{kind}_{c}" for c in columns for kind in ("sum", "count")]
    sums = [f"__upto_{a}" for a in added]
    placed = stage(prefix_sums(indexed, ["__series"], added, index="__idx", chunk_rows=chunk_rows), "frames")
    marks = placed.select("__series", F.col("__at").alias("__mark"), *[F.col(c).alias("lo" + c) for c in ["__idx", *sums]])
    # The last moment before the frame.
    framed = as_of_join(
        placed.select("__series", "__at", "__idx", *sums, (F.col("__at") - seconds * 1_000_000).alias("__from")), marks, ["__series"], "__from", "__mark", ["lo" + c for c in ["__idx", *sums]],
        ties=["lo__idx"], strict=True, spread=spread)
    framed = stage(framed.withColumn("__first", F.coalesce("lo__idx", F.lit(-1)) + 1).withColumnRenamed("__idx", "__last"), "frames")
    inside_of = {a: F.col(f"__upto_{a}") - F.coalesce(f"lo__upto_{a}", F.lit(0)) for a in added}
    totals = [x for c in columns for x in (
        F.when(inside_of[f"__count_{c}"] > 0, inside_of[f"__sum_{c}"]).alias(f"{c}_sum"), inside_of[f"__count_{c}"].alias(f"{c}_count"))]
    longest = framed.agg(F.max(F.col("__last") - F.col("__first") + 1)).first()[0] or 1
    block = max(1, math.ceil(math.sqrt(longest)))

    spots = placed.select("__series", "__idx", *[f"__{n}_{c}" for c in columns for n, _, _ in extremes]).withColumn("__block", F.floor(F.col("__idx") / block))
    forward = Window.partitionBy("__series", "__block").orderBy("__idx")
    upto, onward = forward.rowsBetween(Window.unboundedPreceding, 0), forward.rowsBetween(0, Window.unboundedFollowing)
    heads = spots.select("__series", F.col("__idx").alias("__last"), *[f(f"__{n}_{c}").over(upto).alias(f"__head_{n}_{c}") for c in columns for n, f, _ in extremes])
    tails = spots.select("__series", F.col("__idx").alias("__first"), *[f(f"__{n}_{c}").over(onward).alias(f"__tail_{n}_{c}") for c in columns for n, f, _ in extremes])
    blocks = spots.groupBy("__series", "__block").agg(*[f(f"__{n}_{c}").alias(f"__{n}_{c}") for c in columns for n, f, _ in extremes])
    framed = framed.withColumn("__b0", F.floor(F.col("__first") / block)).withColumn("__b1", F.floor(F.col("__last") / block))
    # Frames with the same blocks between them share them: about two such pairs for each block, with a block's worth of blocks each.
    pairs = framed.where("__b1 - __b0 > 1").select("__series", "__b0", "__b1").distinct()
    between = pairs.withColumn("__block", F.explode(F.sequence(F.col("__b0") + 1, F.col("__b1") - 1))).join(blocks, ["__series", "__block"]).groupBy("__series", "__b0", "__b1").agg(
        *[f(f"__{n}_{c}").alias(f"__mid_{n}_{c}") for c in columns for n, f, _ in extremes])
    # Frames inside one block: at most a block of rows each, looked up among the block's own rows.
    short = framed.where("__b0 = __b1").select("__series", "__b0", "__first", "__last").distinct()
    inside = short.join(spots.withColumnRenamed("__block", "__b0"), ["__series", "__b0"]).where("__idx BETWEEN __first AND __last").groupBy("__series", "__first", "__last").agg(
        *[f(f"__{n}_{c}").alias(f"__in_{n}_{c}") for c in columns for n, f, _ in extremes])
    met = framed.join(heads, ["__series", "__last"]).join(tails, ["__series", "__first"]).join(between, ["__series", "__b0", "__b1"], "left").join(inside, ["__series", "__first", "__last"], "left")
    chosen = [
        F.when(F.col("__b0") == F.col("__b1"), F.col(f"__in_{n}_{c}")).otherwise(both(f"__tail_{n}_{c}", f"__mid_{n}_{c}", f"__head_{n}_{c}")).alias(f"{c}_{n}")
        for c in columns for n, _, both in extremes]
    names = [f"{c}_{kind}" for c in columns for kind in ("sum", "count", "min", "max")]
    return sizing.attach_lookup(rows, met.select("__series", "__at", *totals, *chosen), ["__series", "__at"]).select(*df.columns, *names)
