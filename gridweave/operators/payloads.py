"""Scoring requests built from Gold tables, parsing of requests, and response contract checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridweave import schemas
from gridweave.functions.scalars import (
    clean_double, column, is_numeric, is_timestamp, iso_text, normalise_json_value, series_start_text,
)
from gridweave.operators import prepare, series

ORDER = [schemas.EVENT_TIME, "settlement_period"]
JSON_OPTIONS = {"ignoreNullFields": "false"}


def payload_struct(df: DataFrame, excluded: Sequence[str], *, target: bool = False) -> Column:
    """Numeric and boolean columns outside `excluded`, nulls and NaN as 0; optionally the target as double."""
    fields = [f for f in df.schema.fields if f.name not in set(excluded) and is_numeric(f)]
    cells = []
    for f in fields:
        value = normalise_json_value(column(f.name), f.dataType)
        if target and f.name == schemas.TARGET:
            value = value.cast("double")
        if isinstance(f.dataType, T.BooleanType):
            value = F.coalesce(value, F.lit(False))
        cells.append(value.alias(f.name))
    return F.struct(*cells)


def context_struct(df: DataFrame, columns: Sequence[str] = tuple(schemas.CONTEXT_COLUMNS), partition: str = "settlement_date",
                   fallback: Column | None = None) -> Column:
    """Readable context of a request; a missing settlement date falls back to its partition value."""
    cells = []
    for name in columns:
        if name not in df.columns:
            cells.append(F.lit("").alias(name))
            continue
        kind = df.schema[name].dataType
        text = iso_text(column(name), kind) if is_timestamp(kind) or isinstance(kind, T.DateType) else column(name).cast("string")
        default = fallback if name == partition and fallback is not None else F.lit("0.0")
        cells.append(F.coalesce(text, default).alias(name))
    return F.struct(*cells)


def instances_json(instances: Column) -> Column:
    return F.to_json(F.struct(instances.alias("instances")), JSON_OPTIONS)


def latest_partition(df: DataFrame, partition: str = "settlement_date") -> DataFrame:
    """Rows of the newest partition. Only the partition column is read to find it."""
    newest = df.agg(F.max(partition).alias("__newest"))
    return df.join(F.broadcast(newest), F.col(partition) == F.col("__newest")).drop("__newest")


def latest_row_payload(df: DataFrame, *, keys: Sequence[str] = (), excluded: Sequence[str] = tuple(schemas.PAYLOAD_EXCLUDED)) -> DataFrame:
    """Request with the newest row of the newest partition (per `keys`, if any), with its context."""
    newest = series.latest_row(latest_partition(df), keys, ORDER)
    return newest.select(
        *keys, instances_json(F.array(payload_struct(newest, excluded))).alias("payload"),
        context_struct(newest).alias("context"),
    )


def sequence_payload(
    df: DataFrame, *, keys: Sequence[str] = (schemas.SERIES,), required_rows: int, excluded: Sequence[str] = tuple(schemas.SEQUENCE_EXCLUDED)
) -> DataFrame:
    """Request with the last `required_rows` rows of every series; shorter series are marked invalid."""
    rows = series.latest_rows(prepare.with_target(df), keys, ORDER, required_rows)
    body = payload_struct(rows, excluded, target=True)
    cell = F.struct(*[column(c).alias(f"__o{i}") for i, c in enumerate(ORDER)], body.alias("body"))
    packed = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(cell)).alias("cells"),  # at most `required_rows` per series
        F.max_by(context_struct(rows), F.struct(*ORDER)).alias("context"),
    )
    enough = F.size("cells") == required_rows
    return packed.select(
        *keys, enough.alias("valid"),
        F.when(enough, instances_json(F.col("cells.body"))).alias("payload"),
        F.when(~enough, F.format_string(f"need at least {required_rows} rows, found %d", F.size("cells"))).alias("error"),
        "context",
    )


def history_future_payload(
    df: DataFrame, covariates: Sequence[str], *, keys: Sequence[str] = (schemas.SERIES,), context: int, horizon: int,
    samples: int = 100,
) -> DataFrame:
    """Request `{start, target, dynamic_feat}`: target over the history, covariates over history and future."""
    total = context + horizon
    rows = series.latest_rows(prepare.with_target(df), keys, ORDER, total)
    present = [clean_double(df, c) if c in df.columns else F.lit(0.0) for c in covariates]
    cell = F.struct(*[column(c).alias(f"__o{i}") for i, c in enumerate(ORDER)],
                    clean_double(df, schemas.TARGET).alias("y"), *[x.alias(f"x{i}") for i, x in enumerate(present)])
    packed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(cell)).alias("cells"))  # at most `total` per series
    enough = F.size("cells") == total
    features = F.array(*[F.col(f"cells.x{i}") for i in range(len(covariates))]).cast("array<array<double>>")
    instance = F.struct(
        series_start_text(F.col("cells")[0]["__o0"]).alias("start"),
        F.slice("cells.y", 1, context).alias("target"), features.alias("dynamic_feat"),
    )
    configuration = F.struct(F.lit(samples).alias("num_samples"), F.array(F.lit("mean")).alias("output_types"))
    body = F.to_json(F.struct(F.array(instance).alias("instances"), configuration.alias("configuration")), JSON_OPTIONS)
    return packed.select(
        *keys, enough.alias("valid"), F.when(enough, body).alias("payload"),
        F.when(~enough, F.format_string(f"need at least {total} rows, found %d", F.size("cells"))).alias("error"),
    )


def payload_for(df: DataFrame, algorithm: str, metrics: dict | None = None, *, keys: Sequence[str] = (schemas.SERIES,)) -> DataFrame:
    """Request in the form the registered algorithm takes (lengths and covariates from its metrics row)."""
    metrics = metrics or {}
    context, horizon = int(metrics.get("context_length", 48)), int(metrics.get("prediction_length", 48))
    if algorithm == "tft":
        return sequence_payload(df, keys=keys, required_rows=context + horizon)
    if algorithm == "deepar":
        return history_future_payload(
            df, list(metrics.get("feature_columns", [])), keys=keys, context=context, horizon=horizon
        )
    if algorithm == "anomaly":
        return latest_row_payload(df, keys=keys)
    return latest_row_payload(df, keys=keys, excluded=[schemas.TARGET, *schemas.PAYLOAD_EXCLUDED])


def parse_requests(df: DataFrame, body: str, instance_schema: str, *, content_type: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of `{"instances": […]}` or bare-list requests, and a table of the requests that are neither.

    Parsed rows carry the request's other columns and `instance_no`.
    """
    record = f"array<struct<{instance_schema}>>"
    others = [column(c) for c in df.columns if c != body]
    marked = df.withColumn("__json", F.try_parse_json(column(body)))
    marked = marked.withColumn("__has_instances", F.try_variant_get("__json", "$.instances", "variant").isNotNull())
    marked = marked.withColumn("__list", F.try_variant_get(
        F.when(F.col("__has_instances"), F.try_variant_get("__json", "$.instances", "variant")).otherwise(F.col("__json")),
        "$", "array<variant>",
    ))
    accepted = F.lit(True) if content_type is None else F.coalesce(column(content_type) == "application/json", F.lit(False))
    error = (
        F.when(~accepted, F.lit("unsupported content type"))
        .when(F.col("__json").isNull(), F.lit("body is not JSON"))
        .when(F.col("__list").isNull(), F.lit("payload must be a list of records"))
    )
    marked = marked.withColumn("error", error)
    bare, wrapped = F.from_json(column(body), record), F.from_json(column(body), f"instances {record}")["instances"]
    rows = (
        marked.where("error IS NULL")
        .select(*others, F.posexplode(F.when(F.col("__has_instances"), wrapped).otherwise(bare)).alias("instance_no", "__i"))
        .select(*others, "instance_no", "__i.*")
    )
    return rows, marked.where("error IS NOT NULL").select(*others, "error")


def predictions_json(df: DataFrame, request: Sequence[str], order: str, prediction: Column) -> DataFrame:
    """`{"predictions": […]}` per request, in the order of its rows."""
    cells = F.sort_array(F.collect_list(F.struct(column(order).alias("o"), prediction.alias("p"))))
    return df.groupBy(*request).agg(cells.alias("__c")).select(
        *request, F.to_json(F.struct(F.col("__c.p").alias("predictions")), JSON_OPTIONS).alias("response")
    )


def _parsed(df: DataFrame, body: str) -> DataFrame:
    """Add the parsed body, its predictions, and the first of them with its type; each step reads the last."""
    return (
        df.withColumn("__json", F.try_parse_json(column(body)))
        .withColumn("__items", F.when(
            F.schema_of_variant("__json").startswith("OBJECT"), F.try_variant_get("__json", "$.predictions", "array<variant>")
        ))
        .withColumn("__first", F.get("__items", F.lit(0)))
        .withColumn("__kind", F.schema_of_variant("__first"))
    )


def _is_number(kind: Column) -> Column:
    return F.coalesce(kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|BOOLEAN)"), F.lit(False))


def _verdict(df: DataFrame, columns: Sequence[str], error: Column) -> DataFrame:
    unreadable = (
        F.when(F.col("__json").isNull(), F.lit("response is not JSON"))
        .when(F.col("__items").isNull() | (F.size("__items") == 0), F.lit("predictions must be a non-empty list"))
        .otherwise(error)
    )
    return df.withColumn("error", unreadable).select(*columns, "error", F.col("error").isNull().alias("valid"))


def check_forecast_responses(df: DataFrame, body: str) -> DataFrame:
    """Add `valid` and `error`: predictions must be numbers or objects with a non-empty numeric `mean`."""
    parsed = _parsed(df, body).withColumn("__means", F.try_variant_get("__first", "$.mean", "array<variant>"))
    kind, means = F.col("__kind"), F.col("__means")
    error = (
        F.when(_is_number(kind), F.lit(None))
        .when(~kind.startswith("OBJECT"), F.lit("predictions must be numbers or prediction objects"))
        .when(means.isNull() | (F.size(means) == 0), F.lit("mean must be a non-empty list"))
        .when(~F.forall(means, lambda m: _is_number(F.schema_of_variant(m))), F.lit("mean values must be numeric"))
    )
    return _verdict(parsed, df.columns, error)


def check_anomaly_responses(df: DataFrame, body: str) -> DataFrame:
    """Add `valid` and `error`: the first prediction must hold a numeric score and a boolean flag."""
    parsed = _parsed(df, body)
    for name in ("anomaly_score", "is_anomaly"):
        parsed = parsed.withColumn(f"__{name}", F.schema_of_variant(F.try_variant_get("__first", f"$.{name}", "variant")))
    score, verdict = F.col("__anomaly_score"), F.col("__is_anomaly")
    error = (
        F.when(~F.col("__kind").startswith("OBJECT"), F.lit("predictions must be objects"))
        .when(score.isNull() | verdict.isNull(), F.lit("anomaly_score and is_anomaly are required"))
        .when(~_is_number(score), F.lit("anomaly_score must be numeric"))
        .when(verdict != "BOOLEAN", F.lit("is_anomaly must be boolean"))
    )
    return _verdict(parsed, df.columns, error)
