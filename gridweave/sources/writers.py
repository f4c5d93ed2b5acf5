"""Table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.session import stage

ROWS_PER_FILE = 5_000_000


def write_partitioned(df: DataFrame, path: str, partition: str, *, incremental: bool = False) -> None:
    """Parquet by date folder. `incremental` replaces only the dates present in `df`.

    AQE's rebalance gathers each date into few files and splits a date that holds too many rows.
    """
    writer = df.hint("rebalance", F.col(partition)).write.mode("overwrite").partitionBy(partition)
    if incremental:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def write_energy_silver(df: DataFrame, path: str, **options) -> None:
    write_partitioned(df, path, "settlement_date", **options)


def write_weather_silver(df: DataFrame, path: str, **options) -> None:
    write_partitioned(df, path, "forecast_date", **options)


def write_forecast_gold(df: DataFrame, path: str, **options) -> None:
    write_partitioned(df, path, "settlement_date", **options)


def write_anomaly_gold(df: DataFrame, path: str, **options) -> None:
    write_partitioned(df, path, "settlement_date", **options)


def write_landing(rows: DataFrame, path: str) -> None:
    """Raw payload text under `<path>/source=<source>/dt=<date>/`, one compact JSON document per line."""
    rows.select("source", "dt", F.col("payload").alias("value")).write.mode("append").partitionBy("source", "dt").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Gzip-compressed JSON Lines."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def write_metrics(metrics: DataFrame, path: str, history: str | None = None) -> None:
    """Metrics document of a run, and optionally a row in the table of all runs."""
    made = stage(metrics, "metrics")
    # A row for each series: they are made in parallel and only then put into one file.
    made.repartition(1).write.mode("overwrite").json(f"{path}/evaluation.json")
    if history:
        made.repartition(1).write.mode("append").parquet(history)


def write_reports(report: DataFrame, path: str) -> None:
    """Promotion reports under `model_family=…/model_package_version=…/`."""
    report.write.mode("append").partitionBy("model_family", "model_package_version").json(path)


def write_feature_group(df: DataFrame, path: str, event_time: str = "interval_start_utc") -> None:
    """Append a version of feature rows to the offline store, by event date, in parallel."""
    dated = df.withColumn("write_time", F.current_timestamp()).withColumn("event_date", F.to_date(F.col(event_time)))
    dated.hint("rebalance", F.col("event_date")).write.mode("append").partitionBy("event_date").parquet(path)
