"""Feature records, feature-group schemas and the keyed offline store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridweave import schemas
from gridweave.functions.scalars import (
    column, feature_text, feature_timestamp, is_floating, is_timestamp, normalise_json_value, record_id,
)
from gridweave.operators import series
from gridweave.sources.keyed import KeyedTable

# Spark types a logical feature type accepts.
LOGICAL = {
    "String": (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType),
    "Integral": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType),
    "Fractional": (T.FloatType, T.DoubleType, T.DecimalType, T.ByteType, T.ShortType, T.IntegerType, T.LongType),
}


def feature_group_schema(definitions: dict[str, str], record_identifier: str = schemas.RECORD_ID) -> T.StructType:
    """Stored schema of a feature group: the id first; the logical type travels as column metadata."""
    stored = {"String": T.StringType(), "Integral": T.LongType(), "Fractional": T.DoubleType()}
    return T.StructType([
        T.StructField(name, stored[kind], True, {"feature_type": kind})
        for name, kind in {record_identifier: "String", **definitions}.items()
    ])


def schema_problems(df: DataFrame, definitions: dict[str, str]) -> list[str]:
    """Defined features that the table lacks or holds in an unfit type."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    missing = [f"{name}: missing" for name in definitions if name not in fields]
    unfit = [
        f"{name}: {fields[name].simpleString()} is not {kind}"
        for name, kind in definitions.items() if name in fields and not isinstance(fields[name], LOGICAL[kind])
    ]
    return missing + unfit


def feature_value(df: DataFrame, name: str):
    """Text of one feature. Timestamps in feature-store form; a null number reads zero, a null text empty."""
    kind = df.schema[name].dataType
    if name in schemas.TIMESTAMP_FEATURES:
        return feature_timestamp(column(name), kind)
    if is_floating(kind) or isinstance(kind, T.NumericType):
        # A missing number reads 0.0 whatever its type.
        return F.when(column(name).isNull(), F.lit("0.0")).otherwise(feature_text(column(name), kind))
    return feature_text(normalise_json_value(column(name), kind), kind if not is_timestamp(kind) else T.StringType())


def feature_records(df: DataFrame, record_identifier: str = schemas.RECORD_ID) -> DataFrame:
    """Add `record`: `[{FeatureName, ValueAsString}]` with the identifier first. No shuffle."""
    def entry(name: str, value):
        return F.struct(F.lit(name).alias("FeatureName"), value.alias("ValueAsString"))

    entries = [entry(record_identifier, record_id(df)), *[entry(n, feature_value(df, n)) for n in df.columns]]
    return df.select(
        record_id(df).alias(record_identifier), column(schemas.EVENT_TIME), F.array(*entries).alias("record")
    )


def to_feature_group(df: DataFrame, definitions: dict[str, str], record_identifier: str = schemas.RECORD_ID) -> DataFrame:
    """Typed rows of a feature group; a table that does not fit its definitions is an error."""
    problems = schema_problems(df, definitions)
    if problems:
        raise ValueError("; ".join(problems))
    stored = {"Integral": "bigint", "Fractional": "double"}
    picks = [
        (column(n).cast(stored[kind]) if kind in stored else feature_value(df, n)).alias(n)
        for n, kind in definitions.items()
    ]
    return df.select(record_id(df).alias(record_identifier), *picks)


def upsert(stored: DataFrame | None, incoming: DataFrame, *, event_time: str = schemas.EVENT_TIME,
           written_at: str = "write_time", record_identifier: str = schemas.RECORD_ID) -> DataFrame:
    """Latest version of every record by event time, write time, publish time, and last by a hash of the row."""
    versions = incoming if stored is None else stored.unionByName(incoming, allowMissingColumns=True)
    published = [c for c in ("publish_time_utc",) if c in versions.columns]
    order = F.struct(event_time, written_at, *published, F.xxhash64(*versions.columns))
    newest = F.max_by(F.struct(*versions.columns), order).alias("__row")
    return versions.groupBy(record_identifier).agg(newest).select("__row.*")


def select_backfill(gold: DataFrame, max_records: int | None = None) -> DataFrame:
    """Rows to backfill: the latest `max_records` of the table, or all of it."""
    keyed = gold.withColumn("__period", F.coalesce(F.col("settlement_period"), F.lit(0)))
    order = [schemas.EVENT_TIME, "__period", *([schemas.SERIES] if schemas.SERIES in gold.columns else [])]
    return series.latest_rows_overall(keyed, order, max_records).drop("__period")


def offline_store(path: str, event_time: str = schemas.EVENT_TIME, record_identifier: str = schemas.RECORD_ID) -> KeyedTable:
    """A feature group's table: of a record the version with the latest event time counts, of equal ones that of the latest run."""
    return KeyedTable(path, [record_identifier], [event_time])


def backfill(
    gold: DataFrame, definitions: dict[str, str], path: str, run: int, *, max_records: int | None = None, record_identifier: str = schemas.RECORD_ID
) -> None:
    """Store the latest `max_records` rows of a Gold table, or all, as typed records of a feature group.

    `run` numbers the runs of a store in order; a run that is tried again replaces what it stored and adds no version.
    """
    chosen = select_backfill(gold, max_records).select(*gold.columns)
    offline_store(path, record_identifier=record_identifier).write(to_feature_group(chosen, definitions, record_identifier), run)
