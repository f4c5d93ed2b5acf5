"""Point-in-time joins: each row meets what was known at its time, and nothing later."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.operators import sizing
from gridweave.session import stage


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    *,
    ties: Sequence[str] = (),
    tolerance_seconds: float | None = None,
    strict: bool = False,
    row_bound: int | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """Every row of `left`, with `values` of the newest row of `right` of the same keys at or before its time (`strict`: before it).

    Of right rows of the same time the one with the greatest `ties` (or else values) counts. A left row without a key or a time, or with nothing
    known in time (within the tolerance, if there is one), has null values; right rows without a time were never known.

    Both sides are put in one order of keys and time, and the last right row is carried on, so no row is repeated however many
    right rows a key has. Groups proven to fit a task are windows. Else the order is spread over the cluster: the last
    right row is carried inside each range, and into a range from those before it, for the keys that lie across a border.
    """
    keys = list(keys)
    names = [f"__k{i}" for i in range(len(keys))]
    whole = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in [*keys, left_time]])
    asked = left.where(whole).select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)], F.col(f"`{left_time}`").alias("__time"), F.struct("*").alias("__left"))
    known = right.select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)], F.col(f"`{right_time}`").alias("__time"),
        F.struct(*[F.col(f"`{t}`") for t in ties or values]).alias("__tie"), F.struct(F.col(f"`{right_time}`").alias("at"), F.struct(*[F.col(f"`{v}`") for v in values]).alias("values")).alias("__right"),
    ).where(F.col("__time").isNotNull())
    if row_bound is None and spread is None:
        row_bound = max(asked.count(), known.count()) if not keys else None
    both = asked.unionByName(known, allowMissingColumns=True).withColumn("__asks", F.col("__left").isNotNull())
    if spread is None:
        spread = not sizing.fits_one_task(both, names, None if row_bound is None else 2 * row_bound)
    if strict:  # a row that asks comes before those of its time
        both = both.withColumn("__late", ~F.col("__asks"))
    order = ["__time", "__late" if strict else "__asks", "__tie"]
    if not spread:
        so_far = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        met = both.select("__asks", "__left", "__time", F.last("__right", ignorenulls=True).over(so_far).alias("__right"))
    else:
        met = _carried(both, names, order)
    near = F.lit(True) if tolerance_seconds is None else (_seconds("__time") - _seconds("__right.at") <= tolerance_seconds)
    found = met.where("__asks").select("__left", F.when(near, F.col("__right.values")).alias("__right"))
    idle = left.where(~F.coalesce(whole, F.lit(False))).select(F.struct("*").alias("__left"), F.lit(None).cast(found.schema["__right"].dataType).alias("__right"))
    return found.unionByName(idle).select("__left.*", *[F.col("__right").getField(v).alias(v) for v in values])


def _seconds(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp")) / 1_000_000


def _carried(both: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """`both` with the last right row so far in `__right`, by ranges of the sorted rows."""
    ranges = max(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), both.count() // sizing.ROWS_PER_TASK + 1)
    # A copy's number makes a run of equal rows divisible; equal rows carry equal values.
    sort_keys = [*keys, *order, "__copy"]
    placed = stage(
        both.withColumn("__copy", F.monotonically_increasing_id()).repartitionByRange(ranges, *sort_keys).sortWithinPartitions(*sort_keys)
        .select(*both.columns, F.monotonically_increasing_id().alias("__place")).withColumn("__range", F.shiftright("__place", 33)), "as-of")
    inside = Window.partitionBy("__range", *keys).orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = placed.withColumn("__here", F.last("__right", ignorenulls=True).over(inside))
    # Only a key in several ranges carries over a border: at most two of them for each range.
    ends = placed.groupBy("__range", *keys).agg(F.max_by("__right", F.when(F.col("__right").isNotNull(), F.col("__place"))).alias("__last"))
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    borders = ends.withColumn("__n", F.count(F.lit(1)).over(by_key)).withColumn("__before", F.last("__last", ignorenulls=True).over(before)).where("__n > 1 AND __before IS NOT NULL")
    borders = stage(borders.select(*[F.col(k).alias(f"__of{k}") for k in keys], F.col("__range").alias("__of_range"), "__before"), "as-of-borders")
    same = [F.col("__range") == F.col("__of_range"), *[F.col(k) == F.col(f"__of{k}") for k in keys]]
    joined = met.join(F.broadcast(borders) if borders.count() <= 2 * ranges else borders, same, "left")
    return joined.select("__asks", "__left", "__time", F.coalesce("__here", "__before").alias("__right"))


def join_weather_as_of(
    energy: DataFrame, weather: DataFrame, published: str = "publish_time_utc", *, local_to_utc: bool = True, row_bound: int | None = None, spread: bool | None = None
) -> DataFrame:
    """Give every demand row, for its hour, the newest weather forecast published at or before the interval starts.

    A forecast that was published later is never used, even where it is the only one: the row then has no weather. `weather` is Silver
    with one more column, the time of publication. Of forecasts of the same time the last landed one counts.
    """
    moment = F.col("forecast_time_local")
    if local_to_utc:
        moment = F.to_utc_timestamp(moment, F.coalesce("timezone", F.lit("UTC")))
    hourly = weather.select(
        F.date_trunc("hour", moment).alias("__hour"), published, "bronze_ingestion_date", "source_object_path",
        F.col("forecast_time_local").alias("weather_timestamp"), *schemas.WEATHER_FEATURE_COLUMNS)
    demand = energy.withColumn("__hour", F.date_trunc("hour", "interval_start_utc"))
    return as_of_join(
        demand, hourly, ["__hour"], "interval_start_utc", published, schemas.WEATHER_COLUMNS,
        ties=["bronze_ingestion_date", "source_object_path"], row_bound=row_bound, spread=spread).drop("__hour")
