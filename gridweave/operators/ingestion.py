"""Landing layout, ingestion manifests and ingestion health, as batch jobs over fetched payloads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.functions.scalars import landing_key
from gridweave.operators import series


def sources(spark: SparkSession) -> DataFrame:
    """The upstream sources and the minutes expected between their landings."""
    return spark.createDataFrame(schemas.PUBLIC_SOURCES, "name string, base_url string, cadence_minutes int")


def landing_rows(payloads: DataFrame, prefix: str) -> DataFrame:
    """Payloads `(source, request_id, event_time_utc, payload)` with their date partition and object key."""
    return payloads.withColumn("dt", F.substring("event_time_utc", 1, 10)).withColumn(
        "s3_key", landing_key(prefix, F.col("source"), F.col("request_id"), F.col("event_time_utc"))
    )


def energy_summary(key: Column, data: Column) -> Column:
    """Manifest entry of a demand payload; the count is absent where `data` is no list."""
    return F.struct(
        F.lit("energy").alias("source_name"), key.alias("s3_key"),
        F.when(data.isNotNull(), F.size(data)).alias("record_count"),
    )


def weather_summary(key: Column, time: Column) -> Column:
    """Manifest entry of a weather payload: hours covered, first and last."""
    return F.struct(
        F.lit("weather").alias("source_name"), key.alias("s3_key"),
        F.when(time.isNotNull(), F.size(time)).alias("hourly_timestamp_count"),
        F.when(F.size(time) > 0, F.get(time, F.lit(0))).alias("forecast_start_time"),
        F.when(F.size(time) > 0, F.get(time, F.size(time) - 1)).alias("forecast_end_time"),
    )


def manifests(requests: DataFrame, *, prefix: str, deployment: str, environment: str, settings: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One manifest per request `(request_id, event_time_utc, trigger, energy_payload, weather_payload)`.

    A payload that is missing or no JSON object makes the whole request `failed`, with the reason and no
    outputs; otherwise both outputs are summarised. `settings` holds the fields recorded per source.
    """
    def summary_input(body: str, schema: str) -> Column:
        return F.from_json(F.col(body), schema)

    def broken(body: str) -> Column:
        kind = F.schema_of_variant(F.try_parse_json(F.col(body)))
        return ~F.coalesce(kind.startswith("OBJECT"), F.lit(False))

    failed = broken("energy_payload") | broken("weather_payload")
    culprit = F.when(broken("energy_payload"), F.lit("energy")).otherwise(F.lit("weather"))
    energy_key = landing_key(prefix, F.lit("energy"), F.col("request_id"), F.col("event_time_utc"))
    weather_key = landing_key(prefix, F.lit("weather"), F.col("request_id"), F.col("event_time_utc"))
    data = summary_input("energy_payload", "data array<string>")["data"]
    hours = summary_input("weather_payload", "hourly struct<time:array<string>>")["hourly"]["time"]
    outputs = F.struct(
        energy_summary(energy_key, data).alias("energy"), weather_summary(weather_key, hours).alias("weather")
    )
    described = F.struct(*[
        F.struct(*[F.lit(v).alias(k) for k, v in fields.items()]).alias(name) for name, fields in settings.items()
    ])
    return requests.select(
        "request_id", "event_time_utc",
        F.lit(deployment).alias("deployment_name"), F.lit(environment).alias("environment"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        described.alias("sources"),
        F.struct(F.lit("ingestion").alias("source"), F.col("trigger")).alias("event"),
        F.when(~failed, outputs).alias("outputs"),
        F.when(failed, F.struct(
            F.lit("InvalidPayload").alias("type"), F.concat(culprit, F.lit(" payload is not a JSON object")).alias("message"),
        )).alias("error"),
    )


def daily_health(manifest: DataFrame) -> DataFrame:
    """Requests per day and status, with the records landed."""
    return manifest.groupBy(F.substring("event_time_utc", 1, 10).alias("dt"), "status").agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.coalesce(F.col("outputs.energy.record_count"), F.lit(0))).cast("bigint").alias("records"),
    )


def landing_gaps(manifest: DataFrame, cadence_minutes: int, *, row_bound: int | None = None) -> DataFrame:
    """Successful landings that came later than the cadence allows after the one before."""
    landed = manifest.where("status = 'success'").select(
        "request_id", F.try_to_timestamp("event_time_utc").alias("landed_at")
    )
    before = {"previous_at": lambda w: F.lag("landed_at").over(w)}
    rows = series.row_windows(landed, [], ["landed_at", "request_id"], before, before=1, row_bound=row_bound)
    minutes = (F.unix_micros("landed_at") - F.unix_micros("previous_at")) / 60_000_000
    return rows.where(minutes > cadence_minutes).select(
        "request_id", "landed_at", "previous_at", minutes.alias("gap_minutes"),
        (F.floor(minutes / cadence_minutes) - 1).cast("int").alias("missed_landings"),
    )


def source_landings(manifest: DataFrame) -> DataFrame:
    """`source, request_id, landed_at` of every output of a successful request, named as in the registry of sources."""
    landed = manifest.where("status = 'success'").withColumn("landed_at", F.try_to_timestamp("event_time_utc"))
    energy, weather = (name for name, _, _ in schemas.PUBLIC_SOURCES)
    outputs = F.array_compact(F.array(
        F.when(F.col("outputs.energy.record_count").isNotNull(), F.lit(energy)), F.when(F.col("outputs.weather.hourly_timestamp_count") > 1, F.lit(weather))))
    return landed.select("request_id", "landed_at", F.explode(outputs).alias("source"))


def outages(landings: DataFrame, registry: DataFrame, *, row_bound: int | None = None, spread: bool | None = None) -> DataFrame:
    """Spans in which a source did not land within its own cadence, and how many landings the run before had.

    `landings` has `source, request_id, landed_at`; the cadence comes from `registry`, a source without one is left out. A span
    reaches from the last landing in time to the next; landings between two spans are an island.
    """
    known = landings.where("landed_at IS NOT NULL").join(registry.select(F.col("name").alias("source"), "cadence_minutes"), "source")
    placed = series.series_index(known, ["source"], ["landed_at", "request_id"], name="__at", row_bound=row_bound, spread=spread)
    one = {"__since": lambda w: F.lag("landed_at").over(w)}
    gaps = series.row_windows(placed, ["source"], ["__at"], one, before=1, row_bound=row_bound, spread=spread, index="__at")
    minutes = (F.unix_micros("landed_at") - F.unix_micros("__since")) / 60_000_000
    late = gaps.where(minutes > F.col("cadence_minutes")).withColumn("minutes", minutes)
    # The outages of a source, far fewer than its landings, in their own order.
    placed_late = series.series_index(late, ["source"], ["__at"], name="__gap", row_bound=row_bound, spread=spread)
    last = {"__start": lambda w: F.lag("__at").over(w)}
    spans = series.row_windows(placed_late, ["source"], ["__gap"], last, before=1, row_bound=row_bound, spread=spread, index="__gap")
    return spans.select(
        "source", F.col("__since").alias("out_since"), F.col("landed_at").alias("back_at"), F.col("request_id").alias("back_with"), "minutes",
        (F.floor(F.col("minutes") / F.col("cadence_minutes")) - 1).cast("int").alias("missed_landings"),
        (F.col("__at") - F.coalesce("__start", F.lit(0))).alias("landings_before"))
