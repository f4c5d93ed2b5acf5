"""Demand, weather and payload tables derived from an `events` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.operators import silver, sizing

HALF_HOUR_MICROS = 1_800_000_000
RECORDS_PER_PAYLOAD = 500
SITE = {"latitude": 51.5, "longitude": -0.125, "timezone": "GMT", "timezone_abbreviation": "GMT", "elevation": 16.0}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with `ts` as a UTC timestamp, its half-hour, and the value in whole hundredths."""
    ts = F.col("ts").cast("timestamp")
    micros = F.unix_micros(ts)
    return table(spark, folder, "events").select(
        "event_id", "event_type", "value", ts.alias("ts"),
        F.timestamp_micros(micros - F.pmod(micros, F.lit(HALF_HOUR_MICROS))).alias("half_hour"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


def slots(spark: SparkSession, folder: str) -> int:
    """Upper bound on the rows of one half-hourly series: the row count from the file footers, or the
    half-hours between the first and the last event where that is too many for one task."""
    rows = table(spark, folder, "events").count()
    if rows > sizing.ROWS_PER_TASK:
        first, last = events(spark, folder).agg(F.min("half_hour"), F.max("half_hour")).first()
        rows = min(rows, int((last - first).total_seconds() // 1800) + 1)
    return rows


def few_rows(spark: SparkSession, folder: str) -> int | None:
    """Row count of the events where it bounds any group of a derived table; None asks for a measurement."""
    rows = table(spark, folder, "events").count()
    return rows if rows <= sizing.ROWS_PER_TASK else None


def settlement_period(half_hour: Column) -> Column:
    return (F.hour(half_hour) * 2 + F.floor(F.minute(half_hour) / 30) + 1).cast("int")


def payload_path() -> Column:
    """Payload file an event came in: at most 500 events of one day."""
    block = F.floor(F.col("event_id") / RECORDS_PER_PAYLOAD).cast("string")
    day = F.date_format("ts", "yyyy-MM-dd")
    return F.concat(F.lit("bronze/raw/energy/dt="), day, F.lit("/req-"), block, F.lit(".json"))


def energy_records(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as one published demand record, with the payload file it came in."""
    e = events(spark, folder)
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return e.select(
        F.struct(
            F.col("event_type").alias("dataset"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("publishTime"),
            F.date_format("half_hour", iso).alias("startTime"),
            F.date_format("half_hour", "yyyy-MM-dd").alias("settlementDate"),
            settlement_period(F.col("half_hour")).alias("settlementPeriod"),
            F.col("cents").cast("int").alias("demand"),
        ).alias("record"),
        payload_path().alias("source_object_path"),
    )


def bronze_energy(spark: SparkSession, folder: str) -> DataFrame:
    """Nested demand payloads of at most 500 records."""
    return energy_records(spark, folder).groupBy("source_object_path").agg(F.collect_list("record").alias("data"))


def silver_energy(spark: SparkSession, folder: str) -> DataFrame:
    """Published demand records, flat, with their repeats."""
    e = events(spark, folder)
    path = payload_path()
    return e.select(
        F.col("event_type").alias("dataset_name"), settlement_period(F.col("half_hour")).alias("settlement_period"),
        F.col("cents").cast("int").alias("demand_mw"), path.alias("source_object_path"), F.col("ts").alias("publish_time_utc"),
        F.col("half_hour").alias("interval_start_utc"), F.to_date("half_hour").alias("settlement_date"),
        (F.col("half_hour") + F.expr("INTERVAL 30 MINUTES")).alias("interval_end_utc"),
        silver.ingestion_date(path, True).alias("bronze_ingestion_date"),
    )


def weather_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly weather stand-in per event type; each type plays one landing of the same forecast."""
    return events(spark, folder).groupBy("event_type", F.date_trunc("hour", "half_hour").alias("hour")).agg(
        (F.expr("sum(cents) div count(1)") / 100).alias("temperature_2m"),
        F.pmod(F.count(F.lit(1)), F.lit(101)).cast("int").alias("relative_humidity_2m"),
        F.max("value").alias("wind_speed_10m"), F.max("ts").alias("last_ts"),
    )


def weather_path(day: Column) -> Column:
    return F.concat(F.lit("bronze/raw/weather/dt="), day, F.lit("/"), F.col("event_type"), F.lit(".json"))


def bronze_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Nested weather payloads: for each day and landing parallel hourly arrays."""
    names = ["temperature_2m", "relative_humidity_2m", "wind_speed_10m"]
    cell = F.struct(F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"), *names)
    days = weather_hours(spark, folder).groupBy("event_type", F.date_format("hour", "yyyy-MM-dd").alias("day")).agg(
        F.sort_array(F.collect_list(cell)).alias("c")  # 24 hours
    )
    return days.select(
        *[F.lit(v).alias(k) for k, v in SITE.items()],
        F.struct(*[F.col(f"c.{n}").alias(n) for n in ["time", *names]]).alias("hourly"),
        weather_path(F.col("day")).alias("source_object_path"),
    )


def silver_weather(spark: SparkSession, folder: str, *, published: bool = False) -> DataFrame:
    """Hourly weather, flat, with every landing; on request with a time of publication, 45 minutes before the hour's last event."""
    day = F.date_format("hour", "yyyy-MM-dd")
    return weather_hours(spark, folder).select(
        *[F.lit(v).alias(k) for k, v in SITE.items()], "temperature_2m", "relative_humidity_2m", "wind_speed_10m",
        weather_path(day).alias("source_object_path"), F.col("hour").alias("forecast_time_local"),
        F.to_date("hour").alias("forecast_date"), day.alias("bronze_ingestion_date"),
        *[(F.col("last_ts") - F.expr("INTERVAL 45 MINUTES")).alias("publish_time_utc")] * published,
    )


def demand(spark: SparkSession, folder: str) -> DataFrame:
    """Half-hourly demand per dataset: the mean value in hundredths, rounded down."""
    half_hours = events(spark, folder).groupBy(F.col("event_type").alias("dataset_name"), F.col("half_hour").alias("interval_start_utc")).agg(
        F.expr("sum(cents) div count(1)").cast("int").alias("demand_mw"), F.max("ts").alias("publish_time_utc")
    )
    start = F.col("interval_start_utc")
    return half_hours.select(
        "dataset_name", "publish_time_utc", "interval_start_utc",
        (start + F.expr("INTERVAL 30 MINUTES")).alias("interval_end_utc"),
        settlement_period(start).alias("settlement_period"), F.to_date(start).alias("settlement_date"),
        "demand_mw", F.date_format(start, "yyyy-MM-dd").alias("bronze_ingestion_date"),
    )
