"""Row index, row windows, splits and latest rows over many time series, however long one of them is."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridweave.operators import sizing
from gridweave.session import stage

CHUNK_ROWS = 65_536
GROUP_LIMIT = 1000  # Spark's own limit for trimming groups before the exchange
TOP_LIMIT = 100_000  # rows each task may keep for a top-N of the whole table


def series_index(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    *,
    name: str = "time_idx",
    size: str | None = None,
    row_bound: int | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """Add the exact 0-based position of each row in its series, and optionally the series length.

    Series proven to fit one task use `row_number`. Longer ones are sorted by range over the whole
    cluster, written once with their place in the sort, and numbered by adding the row counts of the
    ranges before (`spread=True` forces this form).
    """
    series, order = list(series), list(order)
    if spread is None:
        spread = not sizing.fits_one_task(df, series, row_bound)
    if not spread:
        # The same tie-break and type as below.
        by_time = Window.partitionBy(*series).orderBy(*order, "__content")
        out = df.withColumn("__content", F.xxhash64(*df.columns)).withColumn(name, (F.row_number().over(by_time) - 1).cast("bigint")).drop("__content")
        return out.withColumn(size, F.count(F.lit(1)).over(Window.partitionBy(*series))) if size else out
    return _spread_index(df, series, order, name, size)


def _spread_index(df: DataFrame, series: list[str], order: list[str], name: str, size: str | None) -> DataFrame:
    columns = df.columns
    settings = df.sparkSession.conf
    # The tie-breaks make a run of equal rows divisible; only identical rows depend on the second one.
    ties = ["__content", "__copy"]
    sort_keys = [*series, *order, *ties]
    ranges = max(int(settings.get("spark.sql.shuffle.partitions")), df.count() // sizing.ROWS_PER_TASK + 1)
    placed = stage(
        df.withColumn("__content", F.xxhash64(*columns))
        .withColumn("__copy", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *sort_keys)
        .sortWithinPartitions(*sort_keys)
        .select(*columns, F.monotonically_increasing_id().alias("__place"))
        .withColumn("__range", F.shiftright("__place", 33)),
        "placed",
    )
    # One row per (range, series): at most `ranges` rows for the longest series.
    by_range = Window.partitionBy(*series).orderBy("__range")
    ranges_of = placed.groupBy(*series, "__range").agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__place").alias("__first")
    )
    starts = ranges_of.select(
        *series, "__range", "__first",
        F.coalesce(F.sum("__rows").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum("__rows").over(Window.partitionBy(*series)).alias("__size"),
    )
    # Null-safe, so that rows without a series name form a series too. A key holds one range at most.
    starts = stage(starts.withColumnsRenamed({c: f"__of_{c}" for c in [*series, "__range"]}), "starts")
    if starts.count() <= sizing.BROADCAST_ROWS:
        starts = F.broadcast(starts)
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in [*series, "__range"]]
    numbered = placed.join(starts, same)
    index = F.col("__place") - F.col("__first") + F.col("__before")
    return numbered.select(*columns, index.alias(name), *([F.col("__size").alias(size)] if size else []))


def row_windows(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    *,
    before: int,
    after: int = 0,
    row_bound: int | None = None,
    spread: bool | None = None,
    chunk_rows: int = CHUNK_ROWS,
    index: str | None = None,
) -> DataFrame:
    """Add window columns that look at most `before` rows back and `after` rows ahead.

    `columns` maps names to functions of the ordered window. A series too long for one task is cut
    into chunks of `chunk_rows`; the rows next to a border are also sent to the neighbouring chunk, so
    every row still sees its whole frame and the result equals the undivided window. `index` names a
    0-based row index the table already has.
    """
    series, order = list(series), list(order)
    if spread is None:
        spread = not sizing.fits_one_task(df, series, row_bound)
    if not spread:
        spec = Window.partitionBy(*series).orderBy(*order)
        return df.select("*", *[build(spec).alias(name) for name, build in columns.items()])
    if chunk_rows < max(before, after):
        raise ValueError("chunk_rows must cover the frame on either side")

    if index:
        indexed = df.withColumn("__idx", F.col(index))
    else:
        indexed = series_index(df, series, order, name="__idx", spread=True)
    home = F.floor(F.col("__idx") / chunk_rows)
    offset = F.col("__idx") % chunk_rows
    chunks = F.array_compact(
        F.array(
            home,
            F.when(offset >= chunk_rows - before, home + 1),
            F.when((offset < after) & (home > 0), home - 1),
        )
    )
    spec = Window.partitionBy(*series, "__chunk").orderBy("__idx")
    return (
        indexed.withColumn("__home", home)
        .withColumn("__chunk", F.explode(chunks))
        .select("*", *[build(spec).alias(name) for name, build in columns.items()])
        .where("__chunk = __home")
        .select(*df.columns, *columns)
    )


def time_windows(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    *,
    seconds: int,
) -> DataFrame:
    """Add window columns over the last `seconds` of time (not rows), for series with gaps.

    Each series is cut into blocks as long as the frame, and rows are also sent to the next block, so a
    window task holds two frames of one series. Meant for series on a grid, with few rows per frame.
    """
    series = list(series)
    clock = F.unix_micros(F.col(time).cast("timestamp"))
    home = F.floor(clock / (max(seconds, 1) * 1_000_000))
    spec = Window.partitionBy(*series, "__block").orderBy("__clock").rangeBetween(-seconds * 1_000_000, 0)
    return (
        df.withColumn("__clock", clock)
        .withColumn("__home", home)
        .withColumn("__block", F.explode(F.array(F.col("__home"), F.col("__home") + 1)))
        .select("*", *[build(spec).alias(name) for name, build in columns.items()])
        .where("__block = __home")
        .select(*df.columns, *columns)
    )


def chronological_split(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    *,
    minimum_rows: int = 0,
    row_bound: int | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """Mark rows `train` or `test`: the last fifth of each series is held out.

    Under ten rows only the last one is held out; a single row serves as both. Series shorter than
    `minimum_rows` are left out (see `reject_short`).
    """
    n = F.col("__n")
    cut = F.when(n < 10, n - 1).otherwise(F.greatest((n * F.lit(0.8)).cast("bigint"), F.lit(1)))
    parts = F.when(n < 2, F.array(F.lit("train"), F.lit("test"))).otherwise(
        F.array(F.when(F.col("time_idx") < cut, F.lit("train")).otherwise(F.lit("test")))
    )
    indexed = series_index(df, series, order, size="__n", row_bound=row_bound, spread=spread)
    return indexed.where(n >= minimum_rows).withColumn("split", F.explode(parts)).drop("__n")


def horizon_split(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    horizon: int,
    *,
    row_bound: int | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """Mark the last `horizon` rows of each series `holdout`, the rest `train`."""
    indexed = series_index(df, series, order, size="__n", row_bound=row_bound, spread=spread)
    part = F.when(F.col("time_idx") < F.col("__n") - horizon, F.lit("train")).otherwise(F.lit("holdout"))
    return indexed.withColumn("split", part).drop("__n")


def reject_short(df: DataFrame, series: Sequence[str], minimum_rows: int) -> tuple[DataFrame, DataFrame]:
    """Split off series with fewer than `minimum_rows` rows: (kept rows, one row per rejected series)."""
    sizes = df.groupBy(*series).agg(F.count(F.lit(1)).alias("row_count"))
    rejected = sizes.where(F.col("row_count") < minimum_rows).withColumn("required_rows", F.lit(minimum_rows))
    # Rejected series are short by definition, so neither side of this join has a hot key.
    lookup = rejected.select(*series, F.lit(True).alias("__short"))
    kept = sizing.attach_lookup(df, lookup, list(series)).where("__short IS NULL").drop("__short")
    return kept, rejected


def latest_rows(
    df: DataFrame, series: Sequence[str], order: Sequence[str], count: int, *, row_bound: int | None = None
) -> DataFrame:
    """The last `count` rows of each series.

    Up to 1000 Spark trims each input partition to `count` rows per series before the exchange. Larger counts
    go by the row index, which stays balanced for any series.
    """
    if count > GROUP_LIMIT:
        indexed = series_index(df, series, order, name="__idx", size="__n", row_bound=row_bound)
        return indexed.where(F.col("__idx") >= F.col("__n") - count).drop("__idx", "__n")
    newest_first = Window.partitionBy(*series).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__rank", F.row_number().over(newest_first)).where(F.col("__rank") <= count).drop("__rank")


def latest_rows_overall(df: DataFrame, order: Sequence[str], count: int | None) -> DataFrame:
    """The last `count` rows of the whole table, or all of them."""
    if count is None:
        return df
    if count > TOP_LIMIT:
        return latest_rows(df, [], order, count)
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(count)


def latest_row(df: DataFrame, series: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each series, by a partial aggregate instead of a sort."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row")
    grouped = df.groupBy(*series).agg(newest) if series else df.agg(newest).where("__row IS NOT NULL")
    return grouped.select("__row.*")


def encoder_decoder_windows(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    *,
    context: int,
    horizon: int,
    row_bound: int | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """Every full window of `context` history rows and `horizon` rows to predict.

    One row per window start with arrays `<value>_encoder` and `<value>_decoder`.
    """
    length = context + horizon
    frames = {
        f"__{v}": (lambda spec, v=v: F.collect_list(F.coalesce(F.col(v).cast("double"), F.lit(0.0))).over(spec.rowsBetween(0, length - 1)))
        for v in values
    }
    indexed = series_index(df, series, order, row_bound=row_bound, spread=spread)
    windows = row_windows(
        indexed, series, ["time_idx"], frames, before=0, after=length - 1, row_bound=row_bound, spread=spread,
        index="time_idx",
    )
    arrays = [
        part
        for v in values
        for part in (
            F.slice(f"__{v}", 1, context).alias(f"{v}_encoder"),
            F.slice(f"__{v}", context + 1, horizon).alias(f"{v}_decoder"),
        )
    ]
    return windows.where(F.size(f"__{values[0]}") == length).select(*series, "time_idx", *arrays)
