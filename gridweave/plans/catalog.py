"""Registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.functions import aggregates as agg
from gridweave.functions import scalars, sketches
from gridweave.models import boosting, isolation, linear, recurrence, seasonal, trained
from gridweave.operators import asof, evaluation, feature_store, frames, gold, ingestion, payloads, prepare, series, silver, sizing
from gridweave.plans import adapters
from gridweave.session import configure, stage, staging_path
from gridweave.sources import landing, readers, writers
from gridweave.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BY_SERIES = ["dataset_name"]
IN_TIME = ["interval_start_utc", "settlement_period"]
METRICS_GROUP = ["dataset_name"]


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(configure(spark), folder)

    QUERIES[function.__name__] = run
    return function


def text(time: str | Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def six(name: str) -> Column:
    return F.round(F.col(name).cast("double"), 6).alias(name)


def joined(values: str) -> Column:
    """An array of whole numbers as text."""
    return F.array_join(F.transform(values, lambda v: v.cast("bigint").cast("string")), ",")


def gold_forecast(spark: SparkSession, folder: str, **options) -> DataFrame:
    few = adapters.few_rows(spark, folder)
    return gold.forecast_features(
        adapters.demand(spark, folder), adapters.silver_weather(spark, folder),
        energy_bound=few, weather_bound=few, row_bound=few or adapters.slots(spark, folder), **options,
    )


def gold_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    return gold.anomaly_features(gold_forecast(spark, folder, deviation=True))


def gold_table(spark: SparkSession, folder: str) -> DataFrame:
    """The Gold anomaly table written once and read back, as models find it."""
    return stage(gold_anomaly(spark, folder), "gold")


# --- Silver ---------------------------------------------------------------------------------------

def silver_energy_view(df: DataFrame) -> DataFrame:
    return df.select(
        "dataset_name", "settlement_period", "demand_mw", "source_object_path",
        F.date_format("publish_time_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("publish_time_utc"),
        text("interval_start_utc").alias("interval_start_utc"), text("interval_end_utc").alias("interval_end_utc"),
        F.col("settlement_date").cast("string").alias("settlement_date"), "bronze_ingestion_date",
    )


def silver_weather_view(df: DataFrame) -> DataFrame:
    return df.select(
        "latitude", "longitude", "timezone", "timezone_abbreviation", "elevation", six("temperature_2m"),
        "relative_humidity_2m", six("wind_speed_10m"), "source_object_path",
        text("forecast_time_local").alias("forecast_time_local"),
        F.col("forecast_date").cast("string").alias("forecast_date"), "bronze_ingestion_date",
    )


@query
def silver_energy_flatten(spark, folder):
    return silver_energy_view(silver.energy_to_silver(adapters.bronze_energy(spark, folder)))


@query
def silver_weather_flatten(spark, folder):
    return silver_weather_view(silver.weather_to_silver(adapters.bronze_weather(spark, folder)))


@query
def silver_dedup_latest(spark, folder):
    return silver_energy_view(silver.latest_energy(adapters.silver_energy(spark, folder)))


@query
def silver_weather_latest(spark, folder):
    return silver_weather_view(silver.latest_weather(adapters.silver_weather(spark, folder)))


@query
def landing_roundtrip(spark, folder):
    """Payload documents landed as files by source and date, then scanned and flattened."""
    docs = adapters.bronze_energy(spark, folder).select(
        F.lit("energy").alias("source"),
        F.regexp_extract("source_object_path", r"(req-\d+)", 1).alias("request_id"),
        F.regexp_extract("source_object_path", silver.PARTITION_DATE, 1).alias("event_time_utc"),
        F.to_json(F.struct("data")).alias("payload"),
    )
    path = staging_path(spark, "landing")
    writers.write_landing(ingestion.landing_rows(docs, "bronze/raw"), path)
    # One document per line here, so the scan is line-oriented.
    bronze = spark.read.schema(schemas.BRONZE_ENERGY).option("recursiveFileLookup", "true").json(path)
    return silver_energy_view(silver.energy_to_silver(bronze)).drop("source_object_path")


@query
def landing_by_request(spark, folder):
    """Payloads landed as one object per request, read back and flattened; each record knows the object it came in."""
    return silver_energy_view(silver.energy_to_silver(landing.read_landed(spark, landed_energy(spark, folder), schemas.BRONZE_ENERGY)))


@query
def landed_requests(spark, folder):
    """One object per event type and hour, whose request id has characters that must be quoted, found again by that id."""
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm")
    hours = adapters.events(spark, folder).groupBy("event_type", hour.alias("hour")).agg(F.sum("cents").alias("total"), F.count(F.lit(1)).alias("n"))
    docs = hours.select(
        F.lit("sums").alias("source"), F.concat("event_type", F.lit("/"), "hour", F.lit("+0&é")).alias("request_id"),
        F.col("hour").alias("event_time_utc"), F.to_json(F.struct("total", "n")).alias("payload"))
    root = staging_path(spark, "landing")
    landing.land(docs, root, "/raw/")
    return landing.read_landed(spark, root, "total long, n long").select("request_id", "source", "source_object_path", "total", "n")


@query
def bronze_files_silver(spark, folder):
    """Pretty-printed payloads, one file per request in its day's folder; the path of the file read dates the rows."""
    path = staging_path(spark, "bronze")
    day = F.regexp_extract("source_object_path", silver.PARTITION_DATE, 1)
    docs = adapters.bronze_energy(spark, folder).select(day.alias("dt"), F.to_json(F.struct("data"), {"pretty": "true"}).alias("value"))
    docs.write.option("maxRecordsPerFile", 1).partitionBy("dt").text(path)
    return silver_energy_view(silver.energy_to_silver(readers.read_bronze_energy(spark, path))).drop("source_object_path")


@query
def weather_table_roundtrip(spark, folder):
    """Weather Silver written by date and read back."""
    path = staging_path(spark, "weather")
    writers.write_weather_silver(silver.weather_to_silver(adapters.bronze_weather(spark, folder)), path)
    return silver_weather_view(readers.read_table(spark, path))


@query
def silver_table_roundtrip(spark, folder):
    """Silver written by date, then the newest date scanned."""
    path = staging_path(spark, "silver")
    writers.write_energy_silver(silver.latest_energy(adapters.silver_energy(spark, folder)), path)
    return silver_energy_view(readers.read_latest_partition(spark, path))


# --- Gold -----------------------------------------------------------------------------------------

def gold_view(df: DataFrame, *names: str) -> DataFrame:
    return df.select("dataset_name", text("interval_start_utc").alias("interval_start_utc"), *names)


def weather_view() -> list:
    return [text("weather_timestamp").alias("weather_timestamp"), six("temperature_2m"), "relative_humidity_2m", six("wind_speed_10m")]


def joined_weather(spark, folder, mode):
    few = adapters.few_rows(spark, folder)
    return gold.join_weather(
        adapters.demand(spark, folder), adapters.silver_weather(spark, folder), mode=mode, energy_bound=few, weather_bound=few
    )


@query
def gold_join_fanout(spark, folder):
    return gold_view(joined_weather(spark, folder, "raw"), "demand_mw", *weather_view())


@query
def gold_join_latest(spark, folder):
    return gold_view(joined_weather(spark, folder, "latest"), "demand_mw", *weather_view())


@query
def gold_join_balanced(spark, folder):
    """The fan-out join by its large-table plan: hot hours found first, both sides salted."""
    w = adapters.silver_weather(spark, folder)
    hourly = w.select(F.date_trunc("hour", "forecast_time_local").alias("hour"), "temperature_2m", "source_object_path")
    demand = adapters.demand(spark, folder).withColumn("hour", F.date_trunc("hour", "interval_start_utc"))
    out = sizing.balanced_left_join(demand, hourly, ["hour"], force=True)
    return gold_view(out, "demand_mw", six("temperature_2m"), "source_object_path")


@query
def gold_calendar(spark, folder):
    orders = adapters.table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    return gold.add_calendar(orders, "t").select("o_orderkey", "interval_hour", "day_of_week", "month_of_year", "is_weekend")


def windowed(spark, folder, columns, **options):
    return series.row_windows(
        adapters.demand(spark, folder), BY_SERIES, gold.ROW_ORDER, columns, before=schemas.LOOKBACK,
        row_bound=adapters.slots(spark, folder), **options,
    )


@query
def gold_lags(spark, folder):
    lags = {k: v for k, v in gold.lag_and_rolling().items() if k.startswith("lag_")}
    return gold_view(windowed(spark, folder, lags), "demand_mw", *lags)


@query
def gold_rolling(spark, folder):
    names = {k: v for k, v in (gold.lag_and_rolling() | gold.rolling_deviation()).items() if k.startswith("rolling_")}
    return gold_view(windowed(spark, folder, names), "demand_mw", *[six(n) for n in names])


@query
def gold_rolling_past_only(spark, folder):
    names = {k: v for k, v in gold.lag_and_rolling(exclude_current=True).items() if k.startswith("rolling_")}
    return gold_view(windowed(spark, folder, names), *[six(n) for n in names])


@query
def gold_forecast_features(spark, folder):
    out = gold_forecast(spark, folder)
    return gold_view(
        out, "settlement_period", F.col("settlement_date").cast("string").alias("settlement_date"), "demand_mw", *weather_view(),
        "interval_hour", "day_of_week", "month_of_year", "is_weekend", "lag_1_demand_mw", "lag_2_demand_mw", "lag_48_demand_mw",
        six("rolling_mean_48_demand_mw"), "rolling_min_48_demand_mw", "rolling_max_48_demand_mw",
    )


@query
def gold_promoted_scan(spark, folder):
    """Gold fragments of two schemas read as one table, rows without a target left out at the scan."""
    path = staging_path(spark, "fragments")
    rows = gold_forecast(spark, folder).withColumn("demand_mw", F.when(F.col("settlement_period") != 7, F.col("demand_mw")))
    early = F.col("interval_hour") < 12
    rows.where(early).drop("is_weekend").write.parquet(f"{path}/version=1")
    rows.where(~early).write.parquet(f"{path}/version=2")
    return gold_view(readers.read_gold(spark, path, target="demand_mw"), "demand_mw", "is_weekend", "lag_1_demand_mw")


@query
def gold_tables_roundtrip(spark, folder):
    """Both Gold tables written by date and read back, side by side."""
    path = staging_path(spark, "gold-tables")
    features = stage(gold_forecast(spark, folder, deviation=True), "features")
    writers.write_forecast_gold(features.drop("rolling_stddev_48_demand_mw"), f"{path}/forecast")
    writers.write_anomaly_gold(gold.anomaly_features(features), f"{path}/anomaly")
    forecast, anomaly = readers.read_gold(spark, f"{path}/forecast"), readers.read_gold(spark, f"{path}/anomaly")
    both = gold_view(forecast, "lag_2_demand_mw").join(gold_view(anomaly, six("rolling_z_score")), ["dataset_name", "interval_start_utc"])
    return both


@query
def gold_two_sites(spark, folder):
    """Demand meets the weather of two sites: each demand row is there twice, with the same lags."""
    site = adapters.silver_weather(spark, folder)
    north = site.withColumns({"latitude": F.col("latitude") + 1, "temperature_2m": F.col("temperature_2m") + 1})
    few = adapters.few_rows(spark, folder)
    out = gold.forecast_features(
        adapters.demand(spark, folder), site.unionByName(north), energy_bound=few, weather_bound=None if few is None else 2 * few,
        row_bound=few or adapters.slots(spark, folder))
    return gold_view(out, "demand_mw", six("temperature_2m"), "lag_1_demand_mw", "lag_48_demand_mw", six("rolling_mean_48_demand_mw"))


ANOMALY_VIEW = ["rolling_stddev_48_demand_mw", "demand_minus_rolling_mean_mw", "demand_to_rolling_mean_ratio", "rolling_z_score"]


@query
def gold_anomaly_features(spark, folder):
    return gold_view(
        gold_anomaly(spark, folder), "demand_mw", "is_weekend", six("temperature_2m"), "lag_48_demand_mw",
        six("rolling_mean_48_demand_mw"), *[six(n) for n in ANOMALY_VIEW],
    )


@query
def gold_single_series(spark, folder):
    """The whole table as one series, copies and all, through the spread form of the windows."""
    out = gold_forecast(spark, folder, mode="raw", partition_by=(), spread=True)
    keep = ["demand_mw", "lag_1_demand_mw", "lag_48_demand_mw", "rolling_min_48_demand_mw", "rolling_max_48_demand_mw"]
    # Rows that tie in the order may swap, so each timestamp is compared as a whole.
    return out.groupBy(text("interval_start_utc").alias("interval_start_utc")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("demand_mw").alias("demand"), F.sum("lag_48_demand_mw").alias("lag_48"),
        F.round(F.sum("rolling_mean_48_demand_mw"), 4).alias("rolling_mean"),
        F.sum("rolling_min_48_demand_mw").alias("rolling_min"), F.sum("rolling_max_48_demand_mw").alias("rolling_max"),
    )


@query
def rolling_chunked(spark, folder):
    """Exact row windows over one long irregular series, cut into overlapping chunks across the cluster."""
    rows = adapters.events(spark, folder).select("event_id", "ts", "value")
    names = gold.lag_and_rolling("value") | gold.rolling_deviation("value")
    out = series.row_windows(rows, [], ["ts", "event_id"], names, before=48, spread=True, chunk_rows=1024)
    # Eight decimals: a mean of 32 two-decimal values may end in a tie at the sixth.
    return out.select("event_id", *[F.round(n, 8).alias(n) for n in names])


@query
def rolling_time_range(spark, folder):
    """24-hour frames by time instead of 48 rows."""
    def frame(function):
        return lambda w: function("demand_mw").over(w)

    names = {"mean_24h": frame(F.avg), "min_24h": frame(F.min), "max_24h": frame(F.max), "rows_24h": frame(F.count)}
    out = series.time_windows(adapters.demand(spark, folder), BY_SERIES, "interval_start_utc", names, seconds=84_600)
    return gold_view(out, six("mean_24h"), "min_24h", "max_24h", "rows_24h")


@query
def rolling_time_range_dense(spark, folder):
    """The same frames on a plan that gathers none of them."""
    rows = adapters.demand(spark, folder)
    out = frames.dense_time_windows(rows, BY_SERIES, "interval_start_utc", ["demand_mw"], seconds=84_600, chunk_rows=500, spread=True)
    return gold_view(out.withColumn("mean_24h", F.col("demand_mw_sum") / F.col("demand_mw_count")), six("mean_24h"),
                     F.col("demand_mw_min").alias("min_24h"), F.col("demand_mw_max").alias("max_24h"), F.col("demand_mw_count").alias("rows_24h"))


@query
def price_frames(spark, folder):
    """Two weeks of all order lines before each day's lines as one dense series: frames of very many rows."""
    lines = adapters.table(spark, folder, "lineitem").select("l_shipdate", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    out = frames.dense_time_windows(lines, [], "l_shipdate", ["cents"], seconds=14 * 86_400, spread=True)
    return out.groupBy(F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate")).agg(
        *[F.max(c).alias(c) for c in ("cents_sum", "cents_count", "cents_min", "cents_max")], F.min("cents_sum").alias("least_sum"))


# --- Series: index, splits, latest rows -----------------------------------------------------------

@query
def series_row_index(spark, folder):
    """0-based position of every order in the order history, by the spread sort."""
    rows = adapters.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return series.series_index(
        rows, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], size="series_rows", spread=True
    ).select("o_orderkey", "time_idx", "series_rows")


@query
def chrono_split(spark, folder):
    out = series.chronological_split(
        adapters.demand(spark, folder), BY_SERIES, IN_TIME, row_bound=adapters.slots(spark, folder)
    )
    return gold_view(out, "time_idx", "split")


@query
def horizon_split(spark, folder):
    out = series.horizon_split(
        adapters.demand(spark, folder), BY_SERIES, IN_TIME, 48, row_bound=adapters.slots(spark, folder)
    )
    return gold_view(out, "time_idx", "split")


@query
def encoder_decoder_windows(spark, folder):
    out = series.encoder_decoder_windows(
        adapters.demand(spark, folder), BY_SERIES, IN_TIME, ["demand_mw"], context=48, horizon=48,
        row_bound=adapters.slots(spark, folder),
    )
    return out.select(
        "dataset_name", "time_idx",
        joined("demand_mw_encoder").alias("encoder"), joined("demand_mw_decoder").alias("decoder"),
    )


@query
def minimum_rows_guard(spark, folder):
    """Customers with too few orders to model, by the row guard of series training."""
    rows = adapters.table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    _, rejected = series.reject_short(rows, ["o_custkey"], 10)
    return rejected


@query
def latest_n_per_series(spark, folder):
    return gold_view(series.latest_rows(adapters.demand(spark, folder), BY_SERIES, IN_TIME, 96), "demand_mw")


@query
def latest_partition_row(spark, folder):
    newest = payloads.latest_partition(adapters.demand(spark, folder))
    return gold_view(series.latest_row(newest, BY_SERIES, IN_TIME), "demand_mw")


# --- Preparation ----------------------------------------------------------------------------------

@query
def series_records(spark, folder):
    """Training records: everything but the last 48 points of each series, with covariates."""
    rows = gold.add_calendar(adapters.demand(spark, folder))
    out = prepare.series_records(
        rows, ["settlement_period", "is_weekend"], horizon=48, row_bound=adapters.slots(spark, folder)
    )
    return out.select(
        "dataset_name", "segment", "first_index", "start", joined("target").alias("target"),
        joined(F.col("dynamic_feat")[0]).alias("feat_0"), joined(F.col("dynamic_feat")[1]).alias("feat_1"),
    )


@query
def series_records_jsonl(spark, folder):
    """The same records for the test channel, written as gzip JSON Lines and read back."""
    rows = gold.add_calendar(adapters.demand(spark, folder))
    out = prepare.series_records(rows, ["settlement_period"], row_bound=adapters.slots(spark, folder))
    path = staging_path(spark, "records")
    writers.write_json_lines(out, path)
    back = spark.read.schema("dataset_name string, segment long, start string, target array<double>, dynamic_feat array<array<double>>").json(path)
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v).cast("bigint")
    return back.select(
        "dataset_name", "segment", "start", F.size("target").cast("bigint").alias("points"), total("target").alias("demand"),
        total(F.col("dynamic_feat")[0]).alias("periods"),
    )


@query
def sequence_dataset(spark, folder):
    """Encoder/decoder training windows of every series long enough, the last 48 half-hours held out."""
    training, _, _, _, _ = prepare.sequence_dataset(
        gold.add_calendar(adapters.demand(spark, folder)), context=48, horizon=48, row_bound=adapters.slots(spark, folder)
    )
    return training.select(
        "series_id", "time_idx", joined("demand_mw_encoder").alias("encoder"),
        joined("settlement_period_decoder").alias("periods_ahead"),
        F.round(F.col("demand_mw_normalised_decoder")[0], 6).alias("first_normalised"),
    )


@query
def constant_columns(spark, folder):
    rows = gold.add_calendar(adapters.demand(spark, folder)).withColumn("empty", F.lit(None).cast("double"))
    names = ["settlement_period", "demand_mw", "interval_hour", "day_of_week", "month_of_year", "is_weekend", "empty"]
    return prepare.constancy(rows, names)


@query
def feature_frame(spark, folder):
    """Numeric features of the Gold table with gaps read as 0, in training order, plus an absent column."""
    rows = gold_forecast(spark, folder)
    names = [*prepare.preferred_columns(rows), "lag_48_demand_mw"]
    frame = prepare.numeric_features(rows, names, keep=["dataset_name", "interval_start_utc"])
    aligned = prepare.align_features(frame, [*names, "absent_feature"], keep=["dataset_name", "interval_start_utc"])
    return gold_view(aligned, *[six(n) for n in [*names, "absent_feature"]])


@query
def bootstrap_repeat(spark, folder):
    """A table too small to fit (totals per event type) repeated to eight rows."""
    totals = adapters.events(spark, folder).groupBy("event_type").agg(F.sum("cents").alias("cents"))
    return prepare.repeat_to_minimum(totals, 8, ["event_type"])


@query
def group_normaliser(spark, folder):
    panel = adapters.demand(spark, folder).withColumnRenamed("dataset_name", "series_id")
    out = prepare.normalise_target(panel)
    return out.select(
        "series_id", text("interval_start_utc").alias("interval_start_utc"),
        six("target_mean"), six("target_scale"), six("demand_mw_normalised"),
    )


@query
def standardised_columns(spark, folder):
    items = adapters.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    means, deviations = linear.column_stats(items, names)
    scaled = [agg.standardise(F.col(n), F.lit(m), F.lit(s)) for n, m, s in zip(names, means, deviations)]
    return items.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(n) for c, n in zip(scaled, names)])


@query
def inference_panel(spark, folder):
    rows = gold.add_calendar(adapters.demand(spark, folder)).withColumn(
        "demand_mw", F.when(F.col("settlement_period") != 7, F.col("demand_mw"))
    )
    out = prepare.inference_panel(
        rows, ["settlement_period", "absent"], context=48, horizon=48, row_bound=adapters.slots(spark, folder)
    )
    return out.select("series_id", "time_idx", "is_decoder", "demand_mw", "settlement_period", "absent")


# --- Metrics, quantiles, evaluation ---------------------------------------------------------------

def seasonal_naive(spark, folder):
    """Demand with the value one day before as its prediction."""
    names = {"prediction": lambda w: F.lag("demand_mw", 48).over(w)} | {
        k: v for k, v in (gold.lag_and_rolling() | gold.rolling_deviation()).items() if k.startswith("rolling_std")
    }
    return windowed(spark, folder, names).where("prediction IS NOT NULL")


@query
def naive_forecast_metrics(spark, folder):
    out = agg.forecast_metrics(seasonal_naive(spark, folder), METRICS_GROUP, "demand_mw", "prediction")
    return out.select("dataset_name", six("mae"), six("rmse"), six("r2"), "test_rows")


def naive_residuals(spark, folder, rows=None):
    """Residual scores of the seasonal-naive forecast, with the fallback scale of the whole table."""
    rows = stage(seasonal_naive(spark, folder), "naive") if rows is None else rows
    scale = rows.agg(agg.fallback_scale(F.col("demand_mw"))).first()[0]
    deviation = F.col("rolling_stddev_48_demand_mw")
    unit = F.when(deviation > 0, deviation).otherwise(F.lit(scale))
    return rows.withColumn("anomaly_score", F.abs(F.col("demand_mw") - F.col("prediction")) / unit)


@query
def residual_scores(spark, folder):
    return gold_view(naive_residuals(spark, folder), F.col("prediction").alias("predicted_demand_mw"), six("anomaly_score"))


@query
def residual_threshold_flags(spark, folder):
    """Share of half-hours over the 95th percentile of their series' scores."""
    return threshold_flags(spark, folder, stage(seasonal_naive(spark, folder), "naive"))


def threshold_flags(spark, folder, rows):
    scored = stage(naive_residuals(spark, folder, rows).select("dataset_name", "anomaly_score"), "scores")
    cut = agg.exact_quantiles(scored, BY_SERIES, "anomaly_score", [0.95], row_bound=adapters.slots(spark, folder))
    flagged = sizing.attach_lookup(scored, cut, BY_SERIES)
    out = flagged.groupBy("dataset_name").agg(
        F.max("q0").alias("score_threshold"), F.avg("anomaly_score").alias("score_mean"),
        F.stddev_pop("anomaly_score").alias("score_std"), F.count(F.lit(1)).alias("training_rows"),
        F.count_if(F.col("anomaly_score") > F.col("q0")).alias("detected_anomaly_rows"),
    )
    return evaluation.with_anomaly_rate(out).select(
        "dataset_name", six("score_threshold"), six("score_mean"), six("score_std"), "training_rows", "detected_anomaly_rows", six("anomaly_rate")
    )


@query
def exact_quantiles_spread(spark, folder):
    """Interpolated quantiles of line prices by return flag, found by narrowing histograms."""
    items = adapters.table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    out = agg.exact_quantiles(items, ["l_returnflag"], "l_extendedprice", [0.05, 0.5, 0.95], spread=True)
    return out.select("l_returnflag", six("q0"), six("q1"), six("q2"))


@query
def quantile_sketches(spark, folder):
    """Quantiles of line prices by return flag from daily sketches, held against the exact ranks."""
    items = adapters.table(spark, folder, "lineitem").select("l_returnflag", "l_shipdate", "l_extendedprice")
    daily = stage(sketches.quantile_sketches(items, ["l_returnflag", "l_shipdate"], "l_extendedprice"), "sketches")
    shares = [0.01, 0.25, 0.5, 0.9, 0.99]
    found = sketches.quantiles(sketches.merged(daily, ["l_returnflag"]), shares)
    wanted = found.select("l_returnflag", "rows", F.inline(F.array(*[F.struct(F.lit(p).alias("share"), F.col(f"q{i}").alias("value")) for i, p in enumerate(shares)])))
    ranks = items.join(wanted, "l_returnflag").groupBy("l_returnflag", "rows", "share").agg(
        F.sum((F.col("l_extendedprice") < F.col("value")).cast("long")).alias("below"), F.sum((F.col("l_extendedprice") <= F.col("value")).cast("long")).alias("upto"))
    # A share that lies in a run of equal values has no error.
    error = F.greatest(F.lit(0.0), F.col("below") / F.col("rows") - F.col("share"), F.col("share") - F.col("upto") / F.col("rows"))
    return ranks.select("l_returnflag", "share", F.col("rows"), (error <= 2 * sketches.rank_error()).alias("close"))


PROFILE_KEYS = ["dataset_name", "settlement_period", "is_weekend"]


@query
def seasonal_profile_forecast(spark, folder):
    """The last 48 half-hours of each series, forecast by the profile of the rows before."""
    bound = adapters.slots(spark, folder)
    parts = series.horizon_split(gold.add_calendar(adapters.demand(spark, folder)), BY_SERIES, IN_TIME, 48, row_bound=bound)
    profile = seasonal.seasonal_profile(parts.where("split = 'train'"), PROFILE_KEYS, row_bound=bound)
    out = seasonal.profile_forecast(parts.where("split = 'holdout'"), profile, PROFILE_KEYS)
    return gold_view(out, "demand_mw", six("mean"), six("q0"), six("q1"), six("q2"))


@query
def sequence_scores(spark, folder):
    """Profile forecasts of the last 48 half-hours of each series, shifted by its 48 half-hours before."""
    bound = adapters.slots(spark, folder)
    rows = gold.add_calendar(adapters.demand(spark, folder))
    keys = ["series_id", *PROFILE_KEYS[1:]]
    profile = seasonal.seasonal_profile(rows.withColumnRenamed("dataset_name", "series_id"), keys, row_bound=bound)
    request = series.latest_rows(rows, BY_SERIES, IN_TIME, 96)
    out = seasonal.score_sequences(request, profile, context=48, horizon=48, row_bound=bound)
    return out.select("series_id", "time_idx", six("mean"), six("q0"), six("q1"), six("q2"))


@query
def metrics_documents(spark, folder):
    """Metrics rows written as a run's document and as history, and scanned back from both."""
    measured = agg.forecast_metrics(seasonal_naive(spark, folder), METRICS_GROUP, "demand_mw", "prediction")
    path = staging_path(spark, "run")
    writers.write_metrics(measured, path, f"{path}/history")
    document = readers.read_metrics(spark, f"{path}/evaluation.json", names="*.json").select("dataset_name", "mae", "test_rows")
    history = spark.read.parquet(f"{path}/history").select("dataset_name", "rmse")
    both = document.join(history, "dataset_name")
    return both.select("dataset_name", six("mae"), six("rmse"), "test_rows")


def runs(spark, folder):
    """One forecast run and one anomaly run per series, measured on the seasonal-naive predictor."""
    rows = stage(seasonal_naive(spark, folder), "naive")
    forecast = agg.forecast_metrics(rows, METRICS_GROUP, "demand_mw", "prediction").select(
        F.concat("dataset_name", F.lit("-f")).alias("run_id"), F.col("dataset_name").alias("model_group"),
        F.lit("forecast").alias("model_family"), F.col("test_rows").alias("training_rows"), "mae", "rmse", "r2",
        F.lit(None).cast("double").alias("anomaly_rate"),
    )
    anomaly = threshold_flags(spark, folder, rows).select(
        F.concat("dataset_name", F.lit("-a")).alias("run_id"), F.col("dataset_name").alias("model_group"),
        F.lit("anomaly").alias("model_family"), "training_rows",
        *[F.lit(None).cast("double").alias(c) for c in ("mae", "rmse", "r2")], "anomaly_rate",
    )
    return forecast.unionByName(anomaly)


@query
def threshold_checks(spark, folder):
    out = evaluation.threshold_checks(runs(spark, folder), evaluation.thresholds(spark))
    return out.select("run_id", "model_family", "check_order", "name", six("observed"), "comparator", "target", "passed")


@query
def promotion_report(spark, folder):
    checks = evaluation.threshold_checks(runs(spark, folder), evaluation.thresholds(spark))
    out = evaluation.promotion_report(checks, ["run_id", "model_group"])
    failing = F.array_join(F.transform(F.filter("checks", lambda c: ~c["passed"]), lambda c: c["name"]), ",")
    return out.select(
        "run_id", "model_family", "passed", "recommendation", F.size("checks").cast("bigint").alias("checks"), failing.alias("failing"),
        scalars.report_key("reports", F.col("model_family"), F.lit(1), F.lit("20240131000000")).alias("report_key"),
    )


@query
def candidate_ranking(spark, folder):
    """Naive forecasts by three lags, ranked per series by their error on the same rows."""
    rows = gold_forecast(spark, folder).where("lag_48_demand_mw IS NOT NULL")
    lags = F.array(*[F.struct(F.lit(f"lag_{n}").alias("run_id"), F.col(f"lag_{n}_demand_mw").alias("p")) for n in (1, 2, 48)])
    made = rows.select("dataset_name", "demand_mw", F.inline(lags))
    metrics = agg.forecast_metrics(made, ["dataset_name", "run_id"], "demand_mw", "p")
    ranked = evaluation.rank_candidates(metrics, ["dataset_name"])
    return ranked.select("dataset_name", "run_id", six("rmse"), "candidate_rank")


@query
def registry_approvals(spark, folder):
    """Every customer order as a model version: approval of passed versions, then the latest of each kind."""
    orders = adapters.table(spark, folder, "orders")
    versions = orders.select(
        F.col("o_custkey").alias("model_group"), F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"), "o_totalprice",
    )
    registry = evaluation.register(versions)
    report = registry.select("run_id", (F.col("o_totalprice") > 150000).alias("passed"))
    approved = evaluation.apply_approvals(registry, report, ["run_id"])
    newest = evaluation.latest_version(approved).select("model_group", F.col("version").alias("latest_version"))
    ready = evaluation.latest_approved(approved).select("model_group", F.col("version").alias("approved_version"))
    return newest.join(ready, "model_group", "left")


# --- Feature store, payloads, validation ----------------------------------------------------------

@query
def feature_records(spark, folder):
    """Feature name and text value of every cell of the Gold anomaly table."""
    records = feature_store.feature_records(gold_store_rows(spark, folder))
    return records.select("feature_record_id", F.inline("record")).select(
        "feature_record_id", F.col("FeatureName").alias("name"), F.col("ValueAsString").alias("value")
    )


def gold_store_rows(spark, folder):
    rows = windowed(spark, folder, gold.lag_and_rolling() | gold.rolling_deviation())
    rows = gold.add_deviation_ratios(gold.add_calendar(rows))
    return rows.select(
        "dataset_name", "publish_time_utc", "interval_start_utc", "settlement_period", "settlement_date", "demand_mw",
        "is_weekend", "lag_48_demand_mw", "demand_to_rolling_mean_ratio",
    )


@query
def feature_record_ids(spark, folder):
    rows = adapters.silver_energy(spark, folder)
    return rows.select(
        scalars.record_id(rows).alias("feature_record_id"),
        scalars.feature_timestamp(F.col("publish_time_utc"), rows.schema["publish_time_utc"].dataType).alias("published"),
    ).groupBy("feature_record_id").agg(F.max("published").alias("published"), F.count(F.lit(1)).alias("n"))


@query
def feature_group_upsert(spark, folder):
    """Every published record put into a feature group; the latest version of each id remains."""
    rows = adapters.silver_energy(spark, folder)
    incoming = rows.select(
        scalars.record_id(rows).alias("feature_record_id"), "interval_start_utc", "demand_mw",
        F.struct("publish_time_utc", "source_object_path", "demand_mw").alias("write_time"),
    )
    return feature_store.upsert(None, incoming).select("feature_record_id", "demand_mw")


@query
def feature_group_store(spark, folder):
    """Demand rows appended to the offline store twice, the second time as new versions, and read by record."""
    kinds = {n: schemas.FORECAST_FEATURES[n] for n in ("dataset_name", "interval_start_utc", "settlement_period", "demand_mw")}
    rows = adapters.demand(spark, folder)
    path = staging_path(spark, "store")
    writers.write_feature_group(feature_store.to_feature_group(rows, kinds), path)
    again = rows.where("settlement_period <= 24").withColumn("demand_mw", F.col("demand_mw") + 1)
    writers.write_feature_group(feature_store.to_feature_group(again, kinds), path)
    return feature_store.upsert(None, spark.read.parquet(path)).select("feature_record_id", "settlement_period", "demand_mw")


@query
def feature_store_backfill(spark, folder):
    """All Gold anomaly features backfilled into their group: everything, then the latest 1000 rows anew, tried twice, compacted between."""
    gold_rows = stage(gold_anomaly(spark, folder), "gold")
    path = staging_path(spark, "store")
    feature_store.backfill(gold_rows, schemas.ANOMALY_FEATURES, path, 0)
    newer = gold_rows.withColumn("demand_mw", F.col("demand_mw") + 1)
    feature_store.backfill(newer, schemas.ANOMALY_FEATURES, path, 1, max_records=1000)
    feature_store.backfill(newer, schemas.ANOMALY_FEATURES, path, 1, max_records=1000)
    store = feature_store.offline_store(path)
    store.compact(spark)
    feature_store.backfill(newer, schemas.ANOMALY_FEATURES, path, 1, max_records=1000)
    return feature_view(store.read(spark), schemas.ANOMALY_FEATURES)


@query
def feature_store_forecast(spark, folder):
    """All Gold forecast features as a group, read without compaction."""
    path = staging_path(spark, "store")
    feature_store.backfill(gold_forecast(spark, folder), schemas.FORECAST_FEATURES, path, 0)
    return feature_view(feature_store.offline_store(path).read(spark), schemas.FORECAST_FEATURES)


def feature_view(rows: DataFrame, definitions: dict[str, str]) -> DataFrame:
    return rows.select(schemas.RECORD_ID, *[six(n) if kind == "Fractional" else F.col(n) for n, kind in definitions.items()])


@query
def backfill_latest(spark, folder):
    """The latest 1000 demand rows of the whole table."""
    return gold_view(feature_store.select_backfill(adapters.demand(spark, folder), 1000), "demand_mw")


@query
def feature_value_text(spark, folder):
    """Doubles over a wide range of magnitudes as feature text."""
    items = adapters.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    price = F.col("l_extendedprice")
    numbers = {"plain": price, "large": price * 4096.0, "huge": price * 1e13, "small": price / 1048576.0, "tiny": price * F.col("l_discount") / 1e12}
    return items.select("l_orderkey", "l_linenumber", *[scalars.python_float_text(v).alias(k) for k, v in numbers.items()])


@query
def payload_latest_row(spark, folder):
    out = payloads.payload_for(gold.add_calendar(adapters.demand(spark, folder)), "baseline", keys=BY_SERIES)
    pick = lambda name: F.get_json_object("payload", f"$.instances[0].{name}").cast("bigint").alias(name)
    return out.select(
        "dataset_name", pick("settlement_period"), pick("interval_hour"), pick("is_weekend"),
        F.col("context.settlement_date").alias("settlement_date"),
        F.get_json_object("payload", "$.instances[0].demand_mw").isNull().alias("target_hidden"),
    )


@query
def payload_sequence(spark, folder):
    out = payloads.payload_for(adapters.demand(spark, folder), "tft")
    rows = F.from_json("payload", "instances array<struct<settlement_period:int,demand_mw:double>>")["instances"]
    return out.select(
        "dataset_name", "valid", F.size(rows).cast("bigint").alias("instances"),
        joined(F.transform(rows, lambda r: r["demand_mw"])).alias("demand"),
        joined(F.transform(rows, lambda r: r["settlement_period"])).alias("periods"),
    )


@query
def payload_history_future(spark, folder):
    metrics = {"feature_columns": ["settlement_period", "is_weekend"], "context_length": 48, "prediction_length": 48}
    out = payloads.payload_for(gold.add_calendar(adapters.demand(spark, folder)), "deepar", metrics)
    one = F.from_json("payload", "instances array<struct<start:string,target:array<double>,dynamic_feat:array<array<double>>>>")["instances"][0]
    return out.select(
        "dataset_name", "valid", one["start"].alias("start"), joined(one["target"]).alias("target"),
        joined(one["dynamic_feat"][0]).alias("feat_0"), joined(one["dynamic_feat"][1]).alias("feat_1"),
    )


def response_bodies(spark, folder):
    """A response text per event, well-formed or broken in a way that follows from its type and id."""
    e = adapters.events(spark, folder).select("event_id", "event_type", F.col("cents").cast("string").alias("c"))
    shape = F.pmod("event_id", F.lit(3))
    as_text = lambda *parts: F.concat(*[F.lit(p) if p.startswith(("{", "}", "]", "[", '"', ",")) else F.col(p) for p in parts])
    numbers = as_text('{"predictions": [', "c", "]}")
    means = as_text('{"predictions": [{"mean": [', "c", ', "x"]}]}')
    good_means = as_text('{"predictions": [{"mean": [', "c", "]}]}")
    scores = as_text('{"predictions": [{"anomaly_score": ', "c", ', "is_anomaly": true}]}')
    bad_scores = as_text('{"predictions": [{"anomaly_score": ', "c", ', "is_anomaly": 1}]}')
    body = (
        F.when(F.col("event_type") == "view", numbers)
        .when(F.col("event_type") == "click", F.when(shape == 0, means).otherwise(good_means))
        .when(F.col("event_type") == "purchase", F.when(shape == 0, bad_scores).otherwise(scores))
        .when(F.col("event_type") == "signup", F.when(shape == 0, F.lit('{"predictions": []}')).otherwise(F.lit('{"predictions": ["high"]}')))
        .otherwise(F.concat(F.lit('{"predictions": ['), F.col("c")))
    )
    return e.select("event_id", body.alias("body"))


@query
def forecast_response_checks(spark, folder):
    return payloads.check_forecast_responses(response_bodies(spark, folder), "body").select("event_id", "valid")


@query
def anomaly_response_checks(spark, folder):
    return payloads.check_anomaly_responses(response_bodies(spark, folder), "body").select("event_id", "valid")


@query
def request_parsing(spark, folder):
    """Request bodies of both shapes, one per order with an instance per line; other bodies are rejected."""
    items = adapters.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    bodies = items.groupBy("l_orderkey").agg(  # an order has at most a handful of lines
        F.to_json(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity")))).alias("list")
    )
    shape = F.pmod("l_orderkey", F.lit(4))
    body = (
        F.when(shape == 0, F.col("list")).when(shape == 1, F.concat(F.lit('{"rows": '), "list", F.lit("}")))
        .otherwise(F.concat(F.lit('{"instances": '), "list", F.lit("}")))
    )
    rows, rejected = payloads.parse_requests(bodies.select("l_orderkey", body.alias("body")), "body", "l_linenumber:int,l_quantity:double")
    good = rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("instances"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    bad = rejected.select("l_orderkey", F.lit(0).cast("bigint").alias("instances"), F.lit(None).cast("bigint").alias("quantity"))
    return good.unionByName(bad)


@query
def predictions_response(spark, folder):
    """Line quantities answered as `{"predictions": […]}`, one response per order."""
    items = adapters.table(spark, folder, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("int").alias("p"))
    return payloads.predictions_json(items, ["l_orderkey"], "n", F.col("p"))


# --- Ingestion ------------------------------------------------------------------------------------

def ingestion_manifests(spark, folder):
    """A manifest per user and day: the demand payload lists the day's events, every seventh user's is broken."""
    e = adapters.table(spark, folder, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    day = F.date_format("ts", "yyyy-MM-dd")
    hours = F.collect_set(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm"))  # at most 24
    requests = e.groupBy("user_id", day.alias("day")).agg(
        F.max("ts").alias("at"), F.sort_array(hours).alias("time"), F.sort_array(F.collect_list("event_id")).alias("data")
    )
    data = F.to_json(F.struct("data"))
    requests = requests.select(
        F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit("/"), "day").alias("request_id"),
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_time_utc"),
        F.lit("scheduler").alias("trigger"),
        F.when(F.pmod("user_id", F.lit(7)) == 0, F.lit("502 Bad Gateway")).otherwise(data).alias("energy_payload"),
        F.to_json(F.struct(F.struct("time").alias("hourly"))).alias("weather_payload"),
    )
    return ingestion.manifests(
        requests, prefix="bronze/raw/", deployment="demo", environment="dev",
        settings={"energy": {"base_url": "https://data.elexon.co.uk", "path": "/bmrs/api/v1/datasets/ITSDO"},
                  "weather": {"base_url": "https://api.open-meteo.com", "path": "/v1/forecast", "timezone": "GMT"}},
    )


@query
def ingestion_manifest(spark, folder):
    out = ingestion_manifests(spark, folder)
    return out.select(
        "request_id", "status", F.col("outputs.energy.s3_key").alias("energy_key"),
        F.col("outputs.energy.record_count").alias("record_count"),
        F.col("outputs.weather.hourly_timestamp_count").alias("hours"),
        F.col("outputs.weather.forecast_start_time").alias("first_hour"), F.col("outputs.weather.forecast_end_time").alias("last_hour"),
        F.col("error.message").alias("error_message"),
    )


@query
def ingestion_health(spark, folder):
    return ingestion.daily_health(ingestion_manifests(spark, folder))


@query
def ingestion_gaps(spark, folder):
    out = ingestion.landing_gaps(ingestion_manifests(spark, folder), 30)
    return out.select("request_id", text("landed_at").alias("landed_at"), six("gap_minutes"), "missed_landings")


@query
def source_outages(spark, folder):
    """Spans in which a source missed its own cadence, from manifests and the registry of sources."""
    landings = ingestion.source_landings(ingestion_manifests(spark, folder))
    out = ingestion.outages(landings, ingestion.sources(spark))
    return out.select("source", text("out_since").alias("out_since"), text("back_at").alias("back_at"), "back_with", six("minutes"), "missed_landings", "landings_before")


# --- Models ---------------------------------------------------------------------------------------

def scored_view(df: DataFrame, *names) -> DataFrame:
    return gold_view(df, *names, "anomaly_score", "is_anomaly")


def forecast_table(spark: SparkSession, folder: str) -> DataFrame:
    return stage(gold_forecast(spark, folder), "gold")


@query
def gbt_forecast(spark, folder):
    rows = forecast_table(spark, folder)
    model, _ = boosting.train_forecast(rows)
    return gold_view(model.predict(rows), "demand_mw", "prediction")


@query
def gbt_forecast_metrics(spark, folder):
    _, metrics = boosting.train_forecast(forecast_table(spark, folder))
    return metrics


@query
def residual_model_scores(spark, folder):
    rows = gold_table(spark, folder)
    scorer, _ = boosting.train_residual(rows)
    return scored_view(scorer.score(rows), "predicted_demand_mw")


@query
def iforest_scores(spark, folder):
    rows = gold_table(spark, folder)
    forest, _ = isolation.train_isolation(rows)
    return scored_view(forest.score(rows))


@query
def oneclass_scores(spark, folder):
    rows = gold_table(spark, folder)
    boundary, _ = linear.train_one_class(rows)
    return scored_view(boundary.score(rows))


@query
def pca_scores(spark, folder):
    rows = gold_table(spark, folder)
    model, _ = linear.train_reconstruction(rows)
    return scored_view(model.score(rows))


@query
def forecaster_checks(spark, folder):
    """The boosted forecaster after a round trip to disk, its metrics measured again, and the flags of the residual scorer."""
    rows = forecast_table(spark, folder)
    model, metrics = boosting.train_forecast(rows, trees=20)
    path = staging_path(spark, "model")
    model.save(spark, path)
    again = boosting.DemandModel.load(spark, path)
    train, test = boosting.split_table(prepare.with_target(rows), model.features)
    both = again.predict(model.predict(test, "first"), "second")
    y, p = F.col("demand_mw").cast("double"), F.col("second")
    fitted = model.predict(train).agg(F.count(F.lit(1)).alias("training_rows"), (F.avg(F.pow(y - F.col("prediction"), 2)) < F.var_pop(y)).alias("better_than_mean"))
    measured = both.agg(
        F.count(F.lit(1)).alias("test_rows"), F.bool_and(F.col("first") == p).alias("loaded_is_equal"),
        F.avg(F.abs(y - p)).alias("mae"), F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"))
    told = metrics.select(F.col("mae").alias("told_mae"), F.col("rmse").alias("told_rmse"), F.col("test_rows").alias("told_rows"))
    same = (F.abs(F.col("mae") - F.col("told_mae")) < 1e-6) & (F.abs(F.col("rmse") - F.col("told_rmse")) < 1e-6) & (F.col("told_rows") == F.col("test_rows"))

    whole = gold_table(spark, folder)
    scorer, _ = boosting.train_residual(whole, trees=5)
    scored = stage(scorer.score(whole).select("anomaly_score", "is_anomaly"), "scores")
    cut = scored.agg(F.percentile("anomaly_score", F.lit(0.95)).alias("cut"))
    flags = scored.crossJoin(F.broadcast(cut)).agg(F.bool_and(F.col("is_anomaly").cast("boolean") == (F.col("anomaly_score") > F.col("cut"))).alias("flags_hold"))
    # Each side is one row.
    return measured.crossJoin(told).crossJoin(fitted).crossJoin(flags).select(
        "training_rows", "test_rows", "loaded_is_equal", same.alias("metrics_hold"), "better_than_mean", "flags_hold")


@query
def scorer_checks(spark, folder):
    """What the three anomaly scorers put out: their flags against the exact quantile of their scores, and their metrics against their flags."""
    rows = gold_table(spark, folder)
    forest, forest_metrics = isolation.train_isolation(rows)
    boundary, boundary_metrics = linear.train_one_class(rows)
    rebuilt, rebuilt_metrics = linear.train_reconstruction(rows)
    checked = None
    for name, model, metrics, share, strange in (
        ("isolation", forest, forest_metrics, 0.05, lambda s, q: s < q), ("boundary", boundary, boundary_metrics, 0.95, lambda s, q: s > q),
        ("reconstruction", rebuilt, rebuilt_metrics, 0.95, lambda s, q: s > q),
    ):
        scored = stage(model.score(rows).select("anomaly_score", "is_anomaly"), "scores")
        cut = scored.agg(F.percentile("anomaly_score", F.lit(share)).alias("cut"))
        flags = scored.crossJoin(F.broadcast(cut)).agg(  # one row
            F.count(F.lit(1)).alias("rows"), F.count_if("is_anomaly").alias("flagged"), F.avg("anomaly_score").alias("mean"),
            F.bool_and(F.col("is_anomaly").cast("boolean") == strange(F.col("anomaly_score"), F.col("cut"))).alias("flags_hold"))
        told = metrics.select("training_rows", "detected_anomaly_rows", "score_mean")
        one = flags.crossJoin(F.broadcast(told)).select(
            F.lit(name).alias("model"), "rows", "flags_hold",
            ((F.col("training_rows") == F.col("rows")) & (F.col("detected_anomaly_rows") == F.col("flagged")) & (F.abs(F.col("score_mean") - F.col("mean")) < 1e-9)).alias("metrics_hold"),
            (F.col("flagged") <= 0.05 * F.col("rows") + 1).alias("few_flagged"))
        checked = one if checked is None else checked.unionByName(one)
    return checked


@query
def trained_scorer_checks(spark, folder):
    """The boundary's share of outliers and margin, and the encoder's error against that of the linear form, from their scores."""
    rows = gold_table(spark, folder)
    boundary, _, margins = trained.train_nu_boundary(rows)
    encoder, _, errors = trained.train_encoder(rows)
    plain, _ = linear.train_reconstruction(rows)

    def view(name: str, model, better) -> DataFrame:
        scored = model.score(rows)
        share = F.count_if(F.col("is_anomaly").cast("boolean")) / F.count(F.lit(1))
        return scored.agg(F.count(F.lit(1)).alias("rows"), (F.abs(share - trained.NU) < 0.01).alias("near_share"), F.avg("anomaly_score").alias("mean")).select(
            F.lit(name).alias("model"), "rows", "near_share", better.alias("no_worse"))

    linear_error = plain.scores(rows).agg(F.avg("anomaly_score")).first()[0]
    return view("boundary", boundary, F.lit(bool(margins[-1] >= margins[0]))).unionByName(
        view("encoder", encoder, (F.col("mean") <= linear_error * (1 + 1e-6) + 1e-12) & F.lit(errors[-1] <= errors[0])))


@query
def seasonal_arx(spark, folder):
    _, forecast, _ = seasonal.train_seasonal(forecast_table(spark, folder), row_bound=adapters.slots(spark, folder))
    return forecast


@query
def seasonal_arx_metrics(spark, folder):
    _, _, metrics = seasonal.train_seasonal(forecast_table(spark, folder), row_bound=adapters.slots(spark, folder))
    return metrics


@query
def recurrence_scan(spark, folder):
    """A seasonal recurrence along all rows of each series, in chunks of two days."""
    rows = adapters.demand(spark, folder).select("dataset_name", "interval_start_utc", (F.col("demand_mw") / 7919).alias("step"))
    weights, zeros = [F.array(*map(F.lit, x)) for x in ([0.5, 0.25, 0.2], [0.0] * 48)]
    starts = rows.select("dataset_name").distinct().select("dataset_name", weights.alias("weights"), zeros.alias("start"))
    out = recurrence.recur(rows, starts, BY_SERIES, ["interval_start_utc"], "step", (1, 2, 48), chunk_blocks=2, row_bound=adapters.slots(spark, folder))
    return out.select("dataset_name", text("interval_start_utc").alias("interval_start_utc"), six("value"))


@query
def seasonal_fit_equations(spark, folder):
    """Whether each fitted series leaves errors that are at right angles to every term that takes part."""
    bound, covariates = adapters.slots(spark, folder), ["settlement_period", "is_weekend"]
    panel = prepare.indexed_panel(gold.add_calendar(adapters.demand(spark, folder)), covariates, row_bound=bound)
    return seasonal.fit_equations(panel, covariates, row_bound=bound)


# --- Streaming ------------------------------------------------------------------------------------

@query
def stream_halfhour_demand(spark, folder):
    """Half-hour sums by a stream over the events file."""
    source = adapters.table(spark, folder, "events")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    stream = stream.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    out, checkpoint = staging_path(spark, "half-hours"), staging_path(spark, "checkpoint")
    incremental.stream_half_hour_sums(stream, "ts", "event_type", "cents", out, checkpoint).awaitTermination()
    return incremental.read_half_hour_sums(spark, out, "event_type").select(text("interval_start_utc").alias("interval_start_utc"), "event_type", "total", "n")


@query
def stream_silver(spark, folder):
    """Landed objects flattened by a stream; each record knows the object it came in."""
    root = landed_energy(spark, folder)
    out, checkpoint = staging_path(spark, "silver"), staging_path(spark, "checkpoint")
    incremental.stream_energy_to_silver(spark, root, out, checkpoint).awaitTermination()
    rows = readers.read_table(spark, out)
    return silver_energy_view(rows.withColumn("source_object_path", landing.object_key(F.col("source_object_path"), root)))


def landed_energy(spark: SparkSession, folder: str) -> str:
    docs = adapters.bronze_energy(spark, folder).select(
        F.lit("energy").alias("source"), F.regexp_extract("source_object_path", r"(req-\d+)", 1).alias("request_id"),
        F.regexp_extract("source_object_path", silver.PARTITION_DATE, 1).alias("event_time_utc"), F.to_json(F.struct("data")).alias("payload"))
    root = staging_path(spark, "landing")
    landing.land(docs, root, "bronze/raw")
    return root


@query
def stream_relanded_records(spark, folder):
    """Published records that land three times over in files out of order, upserted by micro-batches and compacted between."""
    rows = adapters.silver_energy(spark, folder)
    source, out, checkpoint = (staging_path(spark, label) for label in ("landings", "relanded", "checkpoint"))
    for landing_number in range(3):
        # Every landing has a third of the records, in no order of time, and another third that the one before had.
        part = F.pmod(F.hash("publish_time_utc", "dataset_name"), F.lit(3))
        rows.where(part.isin(landing_number, (landing_number + 1) % 3)).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8).parquet(source)
        incremental.stream_relanded(stream, out, checkpoint, compact_every=2).awaitTermination()
    return silver_energy_view(incremental.read_relanded(spark, out)).select(*["dataset_name", "interval_start_utc", "settlement_period", "publish_time_utc", "settlement_date"])


@query
def stream_gold_refresh(spark, folder):
    """Gold kept up by a stream over demand that lands out of order, partly without a settlement date."""
    rows = adapters.silver_energy(spark, folder)
    undated = F.pmod(F.minute("publish_time_utc"), F.lit(10)) == 3
    rows = rows.withColumn("settlement_date", F.when(~undated, F.col("settlement_date")))
    energy, weather, out, checkpoint = (staging_path(spark, label) for label in ("silver", "weather", "gold", "checkpoint"))
    writers.write_weather_silver(adapters.silver_weather(spark, folder), weather)
    # The later half of every day's records first, then the earlier one.
    late = F.col("settlement_period") > 24
    for part in (late, ~late):
        rows.where(part).write.mode("append").partitionBy("settlement_date").parquet(energy)
        incremental.refresh_gold(spark, energy, weather, out, checkpoint).awaitTermination()
    return gold_view(readers.read_table(spark, out), "demand_mw", text("weather_timestamp").alias("weather_timestamp"), "lag_1_demand_mw", "lag_48_demand_mw", six("rolling_mean_48_demand_mw"), six("temperature_2m"))


# --- Point in time --------------------------------------------------------------------------------

@query
def gold_weather_as_of(spark, folder):
    """Demand with the newest forecast of its hour that was published when the interval began."""
    few = adapters.few_rows(spark, folder)
    out = asof.join_weather_as_of(adapters.demand(spark, folder), adapters.silver_weather(spark, folder, published=True), row_bound=few)
    return gold_view(out, "demand_mw", text("weather_timestamp").alias("weather_timestamp"), six("temperature_2m"), "relative_humidity_2m", six("wind_speed_10m"))


@query
def as_of_carried(spark, folder):
    """The last purchase before each view, carried over ranges of the whole event table as one series."""
    rows = adapters.events(spark, folder).select("event_id", "event_type", "ts", "cents")
    bought = rows.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "ts", F.col("cents").alias("purchase_cents"))
    out = asof.as_of_join(rows.where("event_type = 'view'"), bought, [], "ts", "ts", ["purchase_id", "purchase_cents"], ties=["purchase_id"], spread=True)
    return out.select("event_id", "purchase_id", "purchase_cents")


# --- Operators by themselves, with all they put out ------------------------------------------------

@query
def reports_roundtrip(spark, folder):
    """Promotion reports written below their family and version, and scanned back."""
    checks = evaluation.threshold_checks(runs(spark, folder), evaluation.thresholds(spark))
    path = staging_path(spark, "reports")
    writers.write_reports(evaluation.promotion_report(checks, ["run_id", "model_group"]).withColumn("model_package_version", F.lit(3)), path)
    back = spark.read.json(path)
    return back.select("run_id", "model_group", "model_family", F.col("model_package_version").cast("long").alias("version"), "passed", "recommendation",
                       F.size("checks").cast("bigint").alias("checks"), F.round(F.get("checks", F.lit(0))["target"], 6).alias("first_target"))


@query
def weather_files_silver(spark, folder):
    """Weather payloads landed as objects and read by their schema; each hour knows the object it came in."""
    day = F.regexp_extract("source_object_path", silver.PARTITION_DATE, 1)
    docs = adapters.bronze_weather(spark, folder).select(
        F.lit("weather").alias("source"), landing.request_of(F.col("source_object_path")).alias("request_id"), day.alias("event_time_utc"),
        F.to_json(F.struct(*adapters.SITE, "hourly")).alias("payload"))
    root = staging_path(spark, "landing")
    landing.land(docs, root, "bronze/raw")
    return silver_weather_view(silver.weather_to_silver(landing.read_landed(spark, root, schemas.BRONZE_WEATHER)))


@query
def numeric_selection(spark, folder):
    """Numeric features of the Gold table in its order, with their values counted and summed."""
    rows = gold_forecast(spark, folder)
    names = prepare.numeric_columns(rows, schemas.FORECAST_EXCLUDED)
    cells = [F.struct(F.lit(k).alias("place"), F.lit(n).alias("feature"), F.count(n).alias("known"), F.round(F.sum(F.col(n).cast("double")), 2).alias("total")) for k, n in enumerate(names)]
    return rows.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


@query
def text_coercion(spark, folder):
    """Numbers that come as text, some of them unreadable, as features."""
    kind = F.pmod("event_id", F.lit(6))
    number = F.col("cents").cast("string")
    words = F.when(kind == 0, number).when(kind == 1, F.lit("abc")).when(kind == 2, F.lit("")).when(kind == 3, F.lit("NaN")).when(kind == 5, F.concat(F.lit("-"), number, F.lit(".5")))
    rows = adapters.events(spark, folder).select("event_id", words.alias("words"))
    return rows.select("event_id", scalars.clean_double(rows, "words").alias("value"))


@query
def paired_predictions(spark, folder):
    """Truth and prediction of the same half-hour side by side, from two tables."""
    rows = stage(seasonal_naive(spark, folder), "naive")
    keys = ["dataset_name", "interval_start_utc"]
    return gold_view(agg.pair_predictions(rows.select(*keys, "demand_mw"), rows.select(*keys, "prediction"), keys, "demand_mw"), "actual", "predicted")


@query
def training_errors(spark, folder):
    """What preparation and training say about tables they cannot use."""
    rows = stage(gold_forecast(spark, folder), "gold")
    cases = {
        "no column": lambda: prepare.require_columns(rows, "absent", "demand_mw"),
        "no target": lambda: prepare.with_target(rows.drop("demand_mw")),
        "no rows": lambda: prepare.require_rows(rows.where("demand_mw < 0 AND demand_mw > 0")),
        "no numbers": lambda: prepare.numeric_columns(rows.select("dataset_name", "demand_mw"), schemas.FORECAST_EXCLUDED),
        "too few rows": lambda: boosting.train_residual(rows.limit(2)),
    }
    said = []
    for case, attempt in cases.items():
        try:
            attempt()
        except (KeyError, ValueError) as problem:
            said.append((case, type(problem).__name__, problem.args[0]))
    return spark.createDataFrame(said, "case string, error string, message string").crossJoin(rows.agg(F.count(F.lit(1)).alias("rows")))


@query
def feature_group_schemas(spark, folder):
    """Stored type and known values of every feature of both groups, as their definitions have them."""
    made = None
    for name, definitions, rows in (("forecast", schemas.FORECAST_FEATURES, gold_forecast(spark, folder)), ("anomaly", schemas.ANOMALY_FEATURES, gold_anomaly(spark, folder))):
        stored = feature_store.to_feature_group(rows, definitions)
        fields = feature_store.feature_group_schema(definitions).fields
        cells = [F.struct(F.lit(f.name).alias("feature"), F.lit(f.metadata["feature_type"]).alias("kind"), F.lit(f.dataType.simpleString()).alias("type"),
                          F.lit(stored.schema[f.name].dataType == f.dataType).alias("fits"), F.count(f.name).alias("known")) for f in fields]
        one = stored.agg(F.array(*cells).alias("cells")).select(F.lit(name).alias("feature_group"), F.inline("cells"))
        made = one if made is None else made.unionByName(one)
    return made


@query
def sequence_parts(spark, folder):
    """Validation windows and rejected series of sequence training, where each series has a short one beside it."""
    rows = stage(gold.add_calendar(adapters.demand(spark, folder)), "demand")
    short = series.series_index(rows, BY_SERIES, IN_TIME, name="at", row_bound=adapters.slots(spark, folder)).where("at < 50").drop("at")
    both = rows.unionByName(short.withColumn("dataset_name", F.concat("dataset_name", F.lit("-short"))))
    training, validation, rejected, kept, _ = prepare.sequence_dataset(both, context=48, horizon=48, row_bound=adapters.slots(spark, folder))
    windows = training.groupBy("series_id").agg(F.count(F.lit(1)).alias("windows"))
    held = validation.join(windows, "series_id", "left").select(
        "series_id", F.lit("kept").alias("part"), F.coalesce("windows", F.lit(0)).alias("rows"), joined("demand_mw_encoder").alias("encoder"), joined("demand_mw_decoder").alias("decoder"))
    return held.unionByName(rejected.select(
        "series_id", F.lit("rejected").alias("part"), F.col("row_count").alias("rows"), F.lit(None).cast("string").alias("encoder"), F.lit(None).cast("string").alias("decoder")))
