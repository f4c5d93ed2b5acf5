"""Scalar column expressions: timestamps, Python-compatible text, JSON-safe values."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def column(name: str) -> Column:
    """A top-level column by its literal name."""
    return F.col(f"`{name}`")


def is_numeric(field: T.StructField) -> bool:
    """Numbers and booleans count as numeric features."""
    return isinstance(field.dataType, (T.NumericType, T.BooleanType))


def is_floating(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def is_timestamp(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.TimestampType, T.TimestampNTZType))


def safe_double(value: Column) -> Column:
    """As double; null, NaN and unreadable text become 0."""
    return F.coalesce(F.nanvl(value.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def clean_double(df: DataFrame, name: str) -> Column:
    """`safe_double` of a column, in the shortest expression its type allows."""
    kind = df.schema[name].dataType
    if is_floating(kind):
        return F.coalesce(F.nanvl(column(name).cast("double"), F.lit(0.0)), F.lit(0.0))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.coalesce(column(name).cast("double"), F.lit(0.0))
    return safe_double(column(name))


def iso_text(value: Column, data_type: T.DataType) -> Column:
    """Timestamps and dates as ISO text: microseconds only where there are any."""
    if isinstance(data_type, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    whole = F.date_trunc("second", value) == value
    return F.when(whole, F.date_format(value, ISO_SECONDS)).otherwise(F.date_format(value, ISO_MICROS))


@F.arrow_udf(T.StringType())
def _python_repr(numbers: pa.Array) -> pa.Array:
    return pa.array([None if x is None else repr(x) for x in numbers.to_pylist()], pa.string())


def python_float_text(value: Column) -> Column:
    """A double as Python prints it: shortest exact digits, positional from 1e-4 up to 1e16.

    The JVM's own text keeps extra digits for some doubles, so Arrow batches go through Python's `repr`.
    """
    return _python_repr(value.cast("double"))


def normalise_json_value(value: Column, data_type: T.DataType) -> Column:
    """JSON-safe form: floating NaN to 0, dates and timestamps to ISO text, numeric null to 0."""
    if is_timestamp(data_type) or isinstance(data_type, T.DateType):
        return iso_text(value, data_type)
    if is_floating(data_type):
        return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(value, F.lit(0).cast(data_type))
    return value


def feature_text(value: Column, data_type: T.DataType) -> Column:
    """A feature value as text; null becomes the empty string."""
    if isinstance(data_type, T.BooleanType):
        text = F.when(value, F.lit("1")).when(~value, F.lit("0"))
    elif is_timestamp(data_type) or isinstance(data_type, T.DateType):
        text = iso_text(value, data_type)
    elif is_floating(data_type):
        text = F.when(F.isnan(value), F.lit("0.0")).otherwise(python_float_text(value))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def feature_timestamp(value: Column, data_type: T.DataType) -> Column:
    """A timestamp as `YYYY-MM-DDTHH:MM:SSZ` in UTC; null or unreadable text becomes empty."""
    moment = F.try_to_timestamp(value) if isinstance(data_type, T.StringType) else value.cast("timestamp")
    return F.coalesce(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))


def series_start_text(value: Column) -> Column:
    """Start of a series as `YYYY-MM-DD HH:MM:SS`; a missing start is an error."""
    text = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(text, F.raise_error(F.lit("series rows need an interval_start_utc value")).cast("string"))


def record_id(df: DataFrame, name: str = "dataset_name", time: str = "interval_start_utc") -> Column:
    """Record identifier `<dataset>|<timestamp>`: an absent dataset column reads `unknown`, a null `0.0`."""
    dataset = F.coalesce(column(name).cast("string"), F.lit("0.0")) if name in df.columns else F.lit("unknown")
    moment = feature_timestamp(column(time), df.schema[time].dataType) if time in df.columns else F.lit("")
    return F.concat_ws("|", dataset, moment)


def landing_key(prefix: str, source: Column, request_id: Column, event_time: Column) -> Column:
    """Object key `<prefix>/<source>/dt=<date>/<quoted request id>.json`."""
    return F.concat(
        F.lit(prefix.strip("/") + "/"), F.trim(source, F.lit("/")), F.lit("/dt="),
        F.substring(event_time, 1, 10), F.lit("/"), F.url_encode(request_id), F.lit(".json"),
    )


def report_key(prefix: str, family: Column, version: Column, timestamp: Column) -> Column:
    """Object key of an evaluation report."""
    return F.concat(
        F.lit(prefix.strip("/") + "/"), family, F.lit("/model_package_version="),
        version.cast("string"), F.lit("/"), timestamp, F.lit(".json"),
    )
