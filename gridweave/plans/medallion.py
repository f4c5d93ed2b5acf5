"""The two table-building jobs end to end: Bronze to Silver, Silver to Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.operators import gold, silver, sizing
from gridweave.session import stage
from gridweave.sources import readers, writers


def bronze_to_silver(spark: SparkSession, energy: str, weather: str, silver_energy: str, silver_weather: str) -> None:
    """Flatten every landed payload; each source is read once and written by date."""
    writers.write_energy_silver(silver.energy_to_silver(readers.read_bronze_energy(spark, energy)), silver_energy)
    writers.write_weather_silver(silver.weather_to_silver(readers.read_bronze_weather(spark, weather)), silver_weather)


def silver_to_gold(
    spark: SparkSession, silver_energy: str, silver_weather: str, forecast: str, anomaly: str, *, parity: bool = False
) -> None:
    """Build both Gold tables from one pass of windows and joins.

    `parity` keeps every landed copy of demand and weather and treats the table as one series.
    """
    energy, weather = readers.read_table(spark, silver_energy), readers.read_table(spark, silver_weather)
    if parity:
        features = gold.forecast_features(energy, weather, mode="raw", partition_by=())
        writers.write_forecast_gold(features, forecast)
        anomalies = gold.anomaly_features(readers.read_table(spark, forecast), mode="raw", partition_by=())
    else:
        bound = rows_per_series(energy, weather)
        features = stage(gold.forecast_features(
            silver.latest_energy(energy), weather, deviation=True, energy_bound=bound, weather_bound=bound, row_bound=bound
        ), "features")
        writers.write_forecast_gold(features.drop(f"rolling_stddev_48_{schemas.TARGET}"), forecast)
        anomalies = gold.anomaly_features(features)
    writers.write_anomaly_gold(anomalies, anomaly)


def rows_per_series(energy: DataFrame, weather: DataFrame) -> int:
    """Bound on the Gold rows of one series and of one hour, from narrow scans of the Silver columns.

    Each demand row meets at most two forecasts per site: one, or two in the hour a local clock repeats.
    """
    sites = weather.select("latitude", "longitude").distinct().count()
    hours = weather.withColumn("hour", F.date_trunc("hour", "forecast_time_local"))
    return max(
        sizing.largest_group(energy, [schemas.SERIES]) * max(2 * sites, 1),
        sizing.largest_group(energy, [schemas.EVENT_TIME]) * 2,
        sizing.largest_group(hours, ["hour"]),
    )
