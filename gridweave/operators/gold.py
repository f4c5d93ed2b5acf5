"""Silver tables to Gold features: weather alignment, calendar, lags, rolling statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.operators import series, silver, sizing

ROW_ORDER = ["interval_start_utc", "settlement_period", "publish_time_utc"]


def join_weather(
    energy: DataFrame,
    weather: DataFrame,
    *,
    mode: str = "latest",
    local_to_utc: bool = True,
    energy_bound: int | None = None,
    weather_bound: int | None = None,
) -> DataFrame:
    """Give every demand row the weather of its hour; demand without weather stays.

    `mode="latest"` takes the newest forecast of each hour and site; `mode="raw"` joins every landed
    forecast of the hour, which repeats the demand row.
    """
    if mode == "latest":
        weather = silver.latest_weather(weather)
    elif mode != "raw":
        raise ValueError(f"unknown weather join mode: {mode}")
    moment = F.col("forecast_time_local")
    if local_to_utc:
        moment = F.to_utc_timestamp(moment, F.coalesce("timezone", F.lit("UTC")))
    hourly = weather.select(
        F.date_trunc("hour", moment).alias("__hour"),
        F.col("forecast_time_local").alias("weather_timestamp"),
        *schemas.WEATHER_FEATURE_COLUMNS,
    )
    demand = energy.withColumn("__hour", F.date_trunc("hour", "interval_start_utc"))
    joined = sizing.balanced_left_join(
        demand, hourly, ["__hour"], left_bound=energy_bound, right_bound=weather_bound
    )
    further = [c for c in energy.columns if c not in schemas.SILVER_ENERGY_COLUMNS]
    return joined.select(*schemas.SILVER_ENERGY_COLUMNS, *schemas.WEATHER_COLUMNS, *further)


def add_calendar(df: DataFrame, time: str = "interval_start_utc") -> DataFrame:
    """Hour, day of week (1 = Sunday), month and weekend flag."""
    weekday = F.dayofweek(time)
    return df.withColumns({
        "interval_hour": F.hour(time),
        "day_of_week": weekday,
        "month_of_year": F.month(time),
        "is_weekend": F.when(weekday.isin(1, 7), 1).otherwise(0),
    })


def lag_and_rolling(target: str = schemas.TARGET, *, exclude_current: bool = False) -> dict:
    """Window columns of the forecast features. `exclude_current` keeps the target out of its own features."""
    first, last = (-48, -1) if exclude_current else (-47, 0)
    return {
        f"lag_1_{target}": lambda w: F.lag(target, 1).over(w),
        f"lag_2_{target}": lambda w: F.lag(target, 2).over(w),
        f"lag_48_{target}": lambda w: F.lag(target, 48).over(w),
        f"rolling_mean_48_{target}": lambda w: F.avg(target).over(w.rowsBetween(first, last)),
        f"rolling_min_48_{target}": lambda w: F.min(target).over(w.rowsBetween(first, last)),
        f"rolling_max_48_{target}": lambda w: F.max(target).over(w.rowsBetween(first, last)),
    }


def rolling_deviation(target: str = schemas.TARGET, *, exclude_current: bool = False) -> dict:
    """Window column of the anomaly features."""
    first, last = (-48, -1) if exclude_current else (-47, 0)
    return {f"rolling_stddev_48_{target}": lambda w: F.stddev_pop(target).over(w.rowsBetween(first, last))}


def add_deviation_ratios(df: DataFrame, target: str = schemas.TARGET) -> DataFrame:
    """Distance from the rolling mean, ratio to it and z-score; null where the divisor is null or zero."""
    mean, spread = F.col(f"rolling_mean_48_{target}"), F.col(f"rolling_stddev_48_{target}")
    return df.withColumns({
        "demand_minus_rolling_mean_mw": F.col(target) - mean,
        "demand_to_rolling_mean_ratio": F.try_divide(F.col(target), mean),
        "rolling_z_score": F.try_divide(F.col(target) - mean, spread),
    })


def forecast_features(
    energy: DataFrame,
    weather: DataFrame,
    *,
    mode: str = "latest",
    partition_by: Sequence[str] = (schemas.SERIES,),
    exclude_current: bool = False,
    deviation: bool = False,
    energy_bound: int | None = None,
    weather_bound: int | None = None,
    row_bound: int | None = None,
    **options,
) -> DataFrame:
    """Gold forecast features. `partition_by=()` treats the whole table as one series.

    In the `latest` mode windows run over the demand rows before weather joins them: a demand row that meets the weather of
    several sites is repeated with the same lags. `deviation` adds the rolling deviation of the anomaly features.
    """
    windows = lag_and_rolling(exclude_current=exclude_current)
    if deviation:
        windows |= rolling_deviation(exclude_current=exclude_current)
    if mode == "latest":
        demand = energy.select(*schemas.SILVER_ENERGY_COLUMNS)
        rolled = series.row_windows(
            add_calendar(demand), partition_by, ROW_ORDER, windows, before=schemas.LOOKBACK, row_bound=row_bound, **options
        )
        return join_weather(rolled, weather, energy_bound=energy_bound, weather_bound=weather_bound)
    joined = join_weather(
        energy, weather, mode=mode, energy_bound=energy_bound, weather_bound=weather_bound
    )
    order = [*ROW_ORDER, "weather_timestamp", *schemas.WEATHER_FEATURE_COLUMNS]
    return series.row_windows(
        add_calendar(joined), partition_by, order, windows, before=schemas.LOOKBACK, row_bound=row_bound, **options,
    )


def anomaly_features(
    forecast: DataFrame,
    *,
    mode: str = "latest",
    partition_by: Sequence[str] = (schemas.SERIES,),
    exclude_current: bool = False,
    row_bound: int | None = None,
    **options,
) -> DataFrame:
    """Gold anomaly features: the forecast features plus rolling deviation, ratios and z-score.

    Forecast features made with `deviation` need no further window, and only they allow for several weather sites.
    """
    if f"rolling_stddev_48_{schemas.TARGET}" in forecast.columns:
        return add_deviation_ratios(forecast)
    order = ROW_ORDER if mode == "latest" else [*ROW_ORDER, "weather_timestamp", *schemas.WEATHER_FEATURE_COLUMNS]
    widened = series.row_windows(
        forecast, partition_by, order, rolling_deviation(exclude_current=exclude_current),
        before=schemas.LOOKBACK, row_bound=row_bound, **options,
    )
    return add_deviation_ratios(widened)
