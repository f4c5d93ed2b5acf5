"""Table schemas (as DDL text), column lists and fixed settings."""

from __future__ import annotations

# Bronze payloads: spelling as in the landed files (the JSON reader matches names case-sensitively).
BRONZE_ENERGY = (
    "data array<struct<dataset:string,publishTime:string,startTime:string,"
    "settlementDate:string,settlementPeriod:int,demand:int>>"
)

BRONZE_WEATHER = (
    "latitude double, longitude double, generationtime_ms double, utc_offset_seconds int, timezone string,"
    "timezone_abbreviation string, elevation double,"
    "hourly_units struct<time:string,temperature_2m:string,relative_humidity_2m:string,wind_speed_10m:string>,"
    "hourly struct<time:array<string>,temperature_2m:array<double>,"
    "relative_humidity_2m:array<int>,wind_speed_10m:array<double>>"
)

BRONZE_MANIFEST = (
    "request_id string, event_time_utc string, deployment_name string, environment string, status string,"
    "sources struct<energy:struct<base_url:string,path:string>,"
    "weather:struct<base_url:string,path:string,latitude:string,longitude:string,"
    "hourly_fields:string,timezone:string>>,"
    "event struct<source:string,trigger:string>,"
    "outputs struct<energy:struct<source_name:string,s3_key:string,record_count:int>,"
    "weather:struct<source_name:string,s3_key:string,hourly_timestamp_count:int,"
    "forecast_start_time:string,forecast_end_time:string>>,"
    "error struct<type:string,message:string>"
)

TARGET = "demand_mw"
EVENT_TIME = "interval_start_utc"
SERIES = "dataset_name"
LOOKBACK = 48

SILVER_ENERGY_COLUMNS = [
    "dataset_name", "publish_time_utc", "interval_start_utc", "interval_end_utc",
    "settlement_period", "settlement_date", "demand_mw", "bronze_ingestion_date",
]
WEATHER_FEATURE_COLUMNS = [
    "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "latitude", "longitude", "timezone",
]
WEATHER_COLUMNS = ["weather_timestamp", *WEATHER_FEATURE_COLUMNS]

# The covariates offered to forecasters, in order of preference.
PREFERRED_COVARIATES = [
    "settlement_period", "temperature_2m", "relative_humidity_2m", "wind_speed_10m",
    "interval_hour", "day_of_week", "month_of_year", "is_weekend",
]

# Columns that never become model features, by training family.
FORECAST_EXCLUDED = ["demand_mw", "interval_start_utc", "settlement_date", "dataset_name"]
ISOLATION_EXCLUDED = ["interval_start_utc", "settlement_date", "dataset_name"]
ANOMALY_EXCLUDED = [
    "interval_start_utc", "interval_end_utc", "settlement_date",
    "dataset_name", "publish_time_utc", "bronze_ingestion_date",
]

# Columns left out of request payloads.
PAYLOAD_EXCLUDED = [
    "interval_start_utc", "interval_end_utc", "settlement_date", "publish_time_utc", "dataset_name",
]
SEQUENCE_EXCLUDED = ["settlement_date", "publish_time_utc", "dataset_name"]
CONTEXT_COLUMNS = ["interval_start_utc", "interval_end_utc", "settlement_date", "publish_time_utc"]

# Feature-group definitions (name, logical type).
TIMESTAMP_FEATURES = ["publish_time_utc", "interval_start_utc", "interval_end_utc", "weather_timestamp"]
RECORD_ID = "feature_record_id"
FORECAST_FEATURES = {
    "dataset_name": "String", "publish_time_utc": "String", "interval_start_utc": "String",
    "interval_end_utc": "String", "settlement_period": "Integral", "settlement_date": "String",
    "demand_mw": "Fractional", "bronze_ingestion_date": "String", "weather_timestamp": "String",
    "temperature_2m": "Fractional", "relative_humidity_2m": "Fractional", "wind_speed_10m": "Fractional",
    "latitude": "Fractional", "longitude": "Fractional", "timezone": "String",
    "interval_hour": "Integral", "day_of_week": "Integral", "month_of_year": "Integral",
    "is_weekend": "Integral", "lag_1_demand_mw": "Fractional", "lag_2_demand_mw": "Fractional",
    "lag_48_demand_mw": "Fractional", "rolling_mean_48_demand_mw": "Fractional",
    "rolling_min_48_demand_mw": "Fractional", "rolling_max_48_demand_mw": "Fractional",
}
ANOMALY_FEATURES = FORECAST_FEATURES | {
    "rolling_stddev_48_demand_mw": "Fractional", "demand_minus_rolling_mean_mw": "Fractional",
    "demand_to_rolling_mean_ratio": "Fractional", "rolling_z_score": "Fractional",
}

# Default promotion thresholds (family, check name, observed metric, comparator, target).
DEFAULT_THRESHOLDS = [
    ("forecast", 1, "min_training_rows", "training_rows", ">=", 48.0),
    ("forecast", 2, "max_mae", "mae", "<=", 5000.0),
    ("forecast", 3, "max_rmse", "rmse", "<=", 7000.0),
    ("forecast", 4, "min_r2", "r2", ">=", 0.0),
    ("anomaly", 1, "min_training_rows", "training_rows", ">=", 48.0),
    ("anomaly", 2, "min_anomaly_rate", "anomaly_rate", ">=", 0.01),
    ("anomaly", 3, "max_anomaly_rate", "anomaly_rate", "<=", 0.20),
]

# Upstream sources (name, base URL, expected minutes between landings).
PUBLIC_SOURCES = [
    ("elexon-bmrs", "https://data.elexon.co.uk", 30),
    ("open-meteo", "https://api.open-meteo.com", 30),
]
