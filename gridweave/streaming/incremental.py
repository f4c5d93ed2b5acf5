"""Incremental runs of the batch transforms over landed files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridweave import schemas
from gridweave.operators import gold, silver
from gridweave.session import stage
from gridweave.sources import readers, writers
from gridweave.sources.keyed import KeyedTable


#: What tells a published record from others.
RECORD = ["dataset_name", "interval_start_utc", "settlement_period", "publish_time_utc"]


def stream_bronze(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Payload files as they land."""
    return spark.readStream.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").json(path)


def stream_energy_to_silver(spark: SparkSession, bronze: str, target: str, checkpoint: str) -> StreamingQuery:
    """Flatten newly landed demand payloads into Silver and stop when caught up."""
    flat = silver.energy_to_silver(stream_bronze(spark, bronze, schemas.BRONZE_ENERGY))
    return (
        flat.writeStream.format("parquet").partitionBy("settlement_date")
        .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_weather_to_silver(spark: SparkSession, bronze: str, target: str, checkpoint: str) -> StreamingQuery:
    flat = silver.weather_to_silver(stream_bronze(spark, bronze, schemas.BRONZE_WEATHER))
    return (
        flat.writeStream.format("parquet").partitionBy("forecast_date")
        .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def drop_relanded(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """Drop copies of a published record that land again within `delay`, and records later than that (`stream_relanded` keeps them)."""
    return stream.withWatermark("publish_time_utc", delay).dropDuplicatesWithinWatermark(RECORD)


def relanded(target: str) -> KeyedTable:
    """Published records by what tells them from others, as they first landed; records without readable times all stay."""
    return KeyedTable(target, RECORD, needs=["interval_start_utc", "publish_time_utc"], first=True)


def stream_relanded(stream: DataFrame, target: str, checkpoint: str, *, compact_every: int = 20) -> StreamingQuery:
    """Published records without a watermark: each micro-batch upserts what landed, no record is too late, and copies collapse.

    A batch that runs again takes its own place. After every `compact_every` batches they are merged, so a read opens few folders.
    """
    table = relanded(target)

    def add(batch: DataFrame, number: int) -> None:
        table.write(batch, number)
        if number % compact_every == compact_every - 1:
            table.compact(batch.sparkSession)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_relanded(spark: SparkSession, target: str) -> DataFrame:
    """One row of each published record of all micro-batches so far."""
    return relanded(target).read(spark)


def half_hour_sums(stream: DataFrame, time: str, key: str, value: str, delay: str = "1 hour") -> DataFrame:
    """Tumbling half-hour windows per key; a window is final once the watermark passes it."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, "30 minutes"), key)
        .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("interval_start_utc"), key, "total", "n")
    )


def stream_half_hour_sums(stream: DataFrame, time: str, key: str, value: str, target: str, checkpoint: str) -> StreamingQuery:
    """Half-hour sums without loss: each micro-batch adds its partial sums in a folder of its own.

    Sums are associative, so windows need no watermark: rows may come as late as they like, no window has to be closed, and
    a batch that runs again replaces its folder. `read_half_hour_sums` adds the parts up.
    """
    def add(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy(F.window(time, "30 minutes"), key).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
        sums.select(F.col("window.start").alias("interval_start_utc"), key, "total", "n").write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_half_hour_sums(spark: SparkSession, target: str, key: str) -> DataFrame:
    """Sums of all micro-batches so far."""
    parts = spark.read.parquet(target)
    return parts.groupBy("interval_start_utc", key).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


#: The day of rows without a readable start: they come before all others of their series. The calendar of files begins about then.
NO_DAY = date(1583, 1, 1)


def interval_day() -> Column:
    return F.coalesce(F.to_date("interval_start_utc"), F.lit(NO_DAY))


def refresh_gold(spark: SparkSession, silver_energy: str, silver_weather: str, gold_path: str, checkpoint: str) -> StreamingQuery:
    """Recompute the Gold days that newly arrived demand rows can change; Gold is laid out by `interval_date`.

    A changed day alters its own rows and, through lags and rolling frames, the 48 rows after it. Those days are
    replaced; the days holding the 48 rows before them are read as history; all others stay untouched. Days are those of the
    interval's start, in the order of the rows, so a record without a settlement date is a row of its day like any other, and
    records without a start have a first day of their own. Of Silver and of the weather only the folders around those days are read.
    """
    def refresh(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        touched = stage(batch.select(interval_day().alias("d")).distinct(), "touched")
        if touched.isEmpty():
            return
        energy = readers.read_table(session, silver_energy).withColumn("interval_date", interval_day())

        def around(low: date, high: date) -> DataFrame:
            """Rows that may start on these days: settlement days are at most a day off."""
            near = F.col("settlement_date").isNull() | F.col("settlement_date").between(_shifted(low, -1), _shifted(high, 1))
            return energy.where(near if low > NO_DAY else near | F.col("interval_start_utc").isNull())

        rewrite, history = affected_dates(rows_per_day(energy, touched, around), touched)
        # Days of the calendar: one narrow row for each day there are rows of, however many rows.
        days = stage(rewrite.select("interval_date").distinct(), "rewrite")
        needed = stage(history.select("interval_date").distinct(), "history")
        low, high = needed.where(F.col("interval_date") > F.lit(NO_DAY)).agg(F.min("interval_date"), F.max("interval_date")).first()
        weather = readers.read_table(session, silver_weather)
        if low:
            weather = weather.where(F.col("forecast_date").isNull() | F.col("forecast_date").between(_shifted(low, -1), _shifted(high, 1)))
        rows = (around(NO_DAY, high or NO_DAY) if needed.where(F.col("interval_date") == F.lit(NO_DAY)).count() else around(low, high)).join(needed, "interval_date", "left_semi")
        features = gold.forecast_features(silver.latest_energy(rows), weather).withColumn("interval_date", interval_day())
        writers.write_partitioned(features.join(days, "interval_date", "left_semi"), gold_path, "interval_date", incremental=True)

    stream = spark.readStream.schema(spark.read.parquet(silver_energy).schema).parquet(silver_energy)
    return stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _shifted(day: date, days: int) -> date:
    return date.fromordinal(min(max(day.toordinal() + days, NO_DAY.toordinal()), date.max.toordinal()))


def rows_per_day(
    energy: DataFrame, touched: DataFrame, around: Callable[[date, date], DataFrame] | None = None, *, rows: int = schemas.LOOKBACK, days: int = 8
) -> DataFrame:
    """Rows per series and `interval_date` after choosing versions, for enough days around the touched ones.

    Reads narrow columns of the days `days` around the touched span (`around` gives the rows that may lie in a span), and goes
    further out only while some series has fewer than `rows` rows on a side of the span and has more rows beyond.
    """
    first, last = touched.agg(F.min("d"), F.max("d")).first()
    day = F.col("interval_date")
    version_key = F.struct("interval_start_utc", "settlement_period")
    while True:
        low, high = _shifted(first, -days), _shifted(last, days)
        near = (around(low, high) if around else energy).where(day.between(low, high))
        counts = stage(near.groupBy("dataset_name", "interval_date").agg(F.count_distinct(version_key).alias("n")), "days")
        sides = stage(counts.groupBy("dataset_name").agg(
            F.sum(F.when(day < first, F.col("n")).otherwise(0)).alias("before"), F.sum(F.when(day > last, F.col("n")).otherwise(0)).alias("after")), "sides")
        lacking = sides.where((F.col("before") < rows) | (F.col("after") < rows))
        if lacking.isEmpty():
            return counts
        outside = energy.where((day < low) | (day > high)).select("dataset_name", day)
        more = ((day < low) & (F.col("before") < rows)) | ((day > high) & (F.col("after") < rows))
        if outside.join(lacking, outside["dataset_name"].eqNullSafe(lacking["dataset_name"])).where(more).isEmpty():
            return counts
        days *= 4


def affected_dates(per_day: DataFrame, touched: DataFrame, rows: int = schemas.LOOKBACK) -> tuple[DataFrame, DataFrame]:
    """(dates to rewrite, dates to read) from row counts per series and date.

    A date is rewritten if it is touched or fewer than `rows` rows lie between it and an earlier touched
    date. It is read if it is rewritten or fewer than `rows` rows lie between it and a later rewritten
    date. Counts run over the calendar dates of a series, which are few.
    """
    days = per_day.join(F.broadcast(touched.select(F.col("d").alias("interval_date"), F.lit(True).alias("__t"))), "interval_date", "left")
    past = Window.partitionBy("dataset_name").orderBy("interval_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy("dataset_name").orderBy("interval_date").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    days = days.withColumn("__end", F.sum("n").over(past)).withColumn("__start", F.col("__end") - F.col("n"))
    days = days.withColumn("__last_touched_end", F.max(F.when(F.col("__t"), F.col("__end"))).over(past))
    rewrite = F.coalesce(F.col("__t"), F.lit(False)) | F.coalesce(F.col("__start") - F.col("__last_touched_end") < rows, F.lit(False))
    days = days.withColumn("__rewrite", rewrite)
    # All series of a rewritten date are rewritten together, because the date folder is replaced.
    whole = days.groupBy("interval_date").agg(F.bool_or("__rewrite").alias("__whole"))
    days = days.join(F.broadcast(whole), "interval_date")
    days = days.withColumn("__next_start", F.min(F.when(F.col("__whole"), F.col("__start"))).over(ahead))
    read = F.col("__whole") | F.coalesce(F.col("__next_start") - F.col("__end") < rows, F.lit(False))
    return days.where("__whole").select("dataset_name", "interval_date"), days.where(read).select("dataset_name", "interval_date")
