"""Bronze payloads to flat Silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION_DATE = r"dt=(\d{4}-\d{2}-\d{2})"


def ingestion_date(path: Column, empty_as_null: bool) -> Column:
    found = F.regexp_extract(path, PARTITION_DATE, 1)
    return F.nullif(found, F.lit("")) if empty_as_null else found


def _source_path(df: DataFrame) -> Column:
    """Lineage path: the file read, or a column of that name on tables that were not read from files."""
    return F.col("source_object_path") if "source_object_path" in df.columns else F.col("_metadata.file_path")


def energy_to_silver(bronze: DataFrame, *, empty_date_as_null: bool = True) -> DataFrame:
    """One row per demand record of every payload."""
    records = bronze.select(F.explode("data").alias("record"), _source_path(bronze).alias("source_object_path"))
    start = F.try_to_timestamp("record.startTime")
    return records.where("record IS NOT NULL").select(
        F.col("record.dataset").alias("dataset_name"),
        F.col("record.settlementPeriod").try_cast("int").alias("settlement_period"),
        F.col("record.demand").try_cast("int").alias("demand_mw"),
        "source_object_path",
        F.try_to_timestamp("record.publishTime").alias("publish_time_utc"),
        start.alias("interval_start_utc"),
        F.col("record.settlementDate").try_cast("date").alias("settlement_date"),
        (start + F.expr("INTERVAL 30 MINUTES")).alias("interval_end_utc"),
        ingestion_date(F.col("source_object_path"), empty_date_as_null).alias("bronze_ingestion_date"),
    )


def weather_to_silver(bronze: DataFrame, *, empty_date_as_null: bool = True) -> DataFrame:
    """One row per forecast hour: the parallel arrays of a payload are zipped, short ones padded with null."""
    site = ["latitude", "longitude", "timezone", "timezone_abbreviation", "elevation"]
    hours = F.arrays_zip("hourly.time", "hourly.temperature_2m", "hourly.relative_humidity_2m", "hourly.wind_speed_10m")
    rows = bronze.select(*site, F.explode(hours).alias("row"), _source_path(bronze).alias("source_object_path"))
    time = F.try_to_timestamp("row.time")
    return rows.select(
        *site,
        F.col("row.temperature_2m").try_cast("double").alias("temperature_2m"),
        F.col("row.relative_humidity_2m").try_cast("int").alias("relative_humidity_2m"),
        F.col("row.wind_speed_10m").try_cast("double").alias("wind_speed_10m"),
        "source_object_path",
        time.alias("forecast_time_local"),
        F.to_date(time).alias("forecast_date"),
        ingestion_date(F.col("source_object_path"), empty_date_as_null).alias("bronze_ingestion_date"),
    )


def _latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key by a partial aggregate: copies collapse before the shuffle, however many."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(newest).select("__row.*")


def _mark_untimed(df: DataFrame, time: str) -> DataFrame:
    """Rows without a readable time are no versions of each other: give them a key of their own."""
    return df.withColumn("__untimed", F.when(F.col(time).isNull(), F.xxhash64(*df.columns)))


def latest_energy(silver: DataFrame) -> DataFrame:
    """Latest published version of each half-hour of each dataset."""
    keys = ["dataset_name", "interval_start_utc", "settlement_period", "__untimed"]
    return _latest(
        _mark_untimed(silver, "interval_start_utc"), keys, ["publish_time_utc", "source_object_path", "demand_mw"]
    ).drop("__untimed")


def latest_weather(silver: DataFrame) -> DataFrame:
    """Latest landed forecast of each hour at each site; hours are UTC, as a local clock repeats one."""
    moment = F.to_utc_timestamp("forecast_time_local", F.coalesce("timezone", F.lit("UTC")))
    keyed = _mark_untimed(silver, "forecast_time_local").withColumn("__hour", F.date_trunc("hour", moment))
    order = ["bronze_ingestion_date", "source_object_path", "forecast_time_local"]
    return _latest(keyed, ["latitude", "longitude", "__hour", "__untimed"], order).drop("__hour", "__untimed")
