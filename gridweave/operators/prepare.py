"""Training-table preparation: feature selection, filling, alignment, series records."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.functions.scalars import clean_double, column, is_numeric, series_start_text
from gridweave.operators import series, sizing

RECORD_POINTS = 200_000  # eleven years of half-hours


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise KeyError(f"table lacks required columns: {', '.join(missing)}")


def require_rows(df: DataFrame, what: str = "training") -> None:
    if df.isEmpty():
        raise ValueError(f"at least one row is required for {what}")


def with_target(df: DataFrame, target: str = schemas.TARGET) -> DataFrame:
    """Rows that have a target."""
    require_columns(df, target)
    return df.where(column(target).isNotNull())


def numeric_columns(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    """Numeric and boolean columns outside `excluded`, in table order. Decided on the schema alone."""
    names = [f.name for f in df.schema.fields if f.name not in set(excluded) and is_numeric(f)]
    if not names:
        raise ValueError("no numeric feature columns are available")
    return names


def preferred_columns(df: DataFrame, preferred: Sequence[str] = schemas.PREFERRED_COVARIATES) -> list[str]:
    """Preferred covariates that exist and are numeric, in preference order."""
    numeric = {f.name for f in df.schema.fields if is_numeric(f)}
    return [name for name in preferred if name in numeric]


def constancy(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column: `column_name`, `is_constant`. A single pass with four aggregates per column."""
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            # Constant: all null, or no null and one value.
            ((F.count(column(name)) == 0)
             | ((F.count(column(name)) == F.count(F.lit(1))) & F.min(column(name)).eqNullSafe(F.max(column(name))))
             ).alias("is_constant"),
        )
        for name in names
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def split_constant_columns(df: DataFrame, names: Sequence[str]) -> tuple[list[str], list[str]]:
    """(kept, dropped) column names; pass the training rows or the whole table as the scope needs."""
    if not names:
        return [], []
    constant = {row["column_name"] for row in constancy(df, names).where("is_constant").collect()}
    return [n for n in names if n not in constant], [n for n in names if n in constant]


def numeric_features(df: DataFrame, names: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns as doubles with null and NaN read as 0, beside the columns in `keep`."""
    return df.select(*[column(k) for k in keep], *[clean_double(df, n).alias(n) for n in names if n not in keep])


def align_features(df: DataFrame, names: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """Columns in training order; only absent columns become 0, nulls inside present ones stay."""
    def pick(name: str) -> Column:
        return column(name).try_cast("double").alias(name) if name in df.columns else F.lit(0.0).alias(name)

    return df.select(*[column(k) for k in keep], *[pick(n) for n in names if n not in keep])


def indexed_panel(
    df: DataFrame,
    covariates: Sequence[str],
    *,
    series_column: str | None = schemas.SERIES,
    constant_id: str = "gb_demand",
    row_bound: int | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """`(series_id, time_idx, demand_mw, *covariates)` in time order per series."""
    name = column(series_column) if series_column else F.lit(constant_id)
    rows = with_target(df).withColumn("series_id", name)
    indexed = series.series_index(
        rows, ["series_id"], [schemas.EVENT_TIME, "settlement_period"], row_bound=row_bound, spread=spread
    )
    return indexed.select(
        "series_id", "time_idx", F.col(schemas.TARGET).cast("double").alias(schemas.TARGET),
        *[clean_double(df, c).alias(c) for c in covariates],
    )


def inference_panel(
    df: DataFrame, covariates: Sequence[str], *, context: int, horizon: int, series_column: str | None = schemas.SERIES,
    row_bound: int | None = None, spread: bool | None = None,
) -> DataFrame:
    """Panel for scoring: the last `horizon` rows per series are to predict.

    Missing demand reads 0 in the history part only. Series shorter than `context + horizon` are an error.
    """
    keys = ["series_id"]
    rows = df.withColumn("series_id", column(series_column) if series_column else F.lit("gb_demand"))
    indexed = series.series_index(
        rows, keys, [schemas.EVENT_TIME, "settlement_period"], size="__n", row_bound=row_bound, spread=spread
    )
    demand = column(schemas.TARGET).try_cast("double") if schemas.TARGET in df.columns else F.lit(0.0)
    needed = context + horizon
    decoder = F.col("time_idx") >= F.col("__n") - horizon
    enough = F.when(
        F.col("__n") < needed,
        F.raise_error(F.lit(f"scoring needs at least {needed} chronological rows per series")).cast("double"),
    )
    return indexed.select(
        "series_id", "time_idx", decoder.alias("is_decoder"),
        F.coalesce(enough, F.when(decoder, demand).otherwise(F.coalesce(demand, F.lit(0.0)))).alias(schemas.TARGET),
        *[(clean_double(df, c) if c in df.columns else F.lit(0.0)).alias(c) for c in covariates],
    )


def normalise_target(panel: DataFrame, keys: Sequence[str] = ("series_id",), target: str = schemas.TARGET) -> DataFrame:
    """Scale the target by its series' mean and standard deviation (columns `target_mean`, `target_scale`)."""
    spread = F.stddev_pop(target)
    stats = panel.groupBy(*keys).agg(
        F.avg(target).alias("target_mean"), F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias("target_scale")
    )
    scaled = sizing.attach_lookup(panel, stats, keys)
    return scaled.withColumn(f"{target}_normalised", (F.col(target) - F.col("target_mean")) / F.col("target_scale"))


def repeat_to_minimum(df: DataFrame, minimum_rows: int, order: Sequence[str]) -> DataFrame:
    """Repeat a tiny table, whole copies in order, until it has `minimum_rows` rows."""
    size = len(df.limit(minimum_rows).select(F.lit(1)).collect())
    if size >= minimum_rows:
        return df
    if size == 0:
        raise ValueError("at least one feature row is required")
    copies = F.explode(F.sequence(F.lit(0), F.lit(math.ceil(minimum_rows / size) - 1)))
    # Fewer than `minimum_rows` rows exist here, so one ordered task is enough.
    place = Window.orderBy("__copy", *order)
    repeated = df.withColumn("__copy", copies).withColumn("__place", F.row_number().over(place))
    return repeated.where(F.col("__place") <= minimum_rows).drop("__copy", "__place")


def series_records(
    df: DataFrame,
    covariates: Sequence[str],
    *,
    series_column: str = schemas.SERIES,
    horizon: int = 0,
    points: int = RECORD_POINTS,
    row_bound: int | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """Time-series records `{segment, first_index, start, target, dynamic_feat}`.

    `horizon` > 0 cuts the last rows off (training records); 0 keeps all (test records). A series is divided evenly into
    segments of at most `points` points, numbered from 0, so no record outgrows a task; most series have one.
    """
    rows = with_target(df)
    indexed = series.series_index(
        rows, [series_column], [schemas.EVENT_TIME, "settlement_period"], size="__n", row_bound=row_bound, spread=spread
    )
    if horizon:
        too_short = F.raise_error(F.lit("a series needs more observations than the forecast horizon")).cast("boolean")
        indexed = indexed.where(
            F.when(F.col("__n") <= horizon, too_short).otherwise(F.col("time_idx") < F.col("__n") - horizon)
        )
    cells = F.struct(
        "time_idx", F.col(schemas.EVENT_TIME).alias("start"), clean_double(df, schemas.TARGET).alias("y"),
        *[clean_double(df, c).alias(f"x{i}") for i, c in enumerate(covariates)],
    )
    kept = F.col("__n") - horizon
    length = F.ceil(kept / F.ceil(kept / points))
    packed = indexed.groupBy(series_column, F.floor(F.col("time_idx") / length).alias("segment")).agg(
        F.sort_array(F.collect_list(cells)).alias("cells")
    )
    features = F.array(*[F.col(f"cells.x{i}") for i in range(len(covariates))])
    return packed.select(
        series_column, "segment", F.col("cells")[0]["time_idx"].alias("first_index"),
        series_start_text(F.col("cells")[0]["start"]).alias("start"),
        F.col("cells.y").alias("target"),
        *([features.alias("dynamic_feat")] if covariates else []),
    )


def series_channels(
    df: DataFrame, horizon: int, *, series_column: str = schemas.SERIES, row_bound: int | None = None, spread: bool | None = None
) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """Training and test records of all series: (train, test, kept covariates, dropped constant covariates)."""
    rows = with_target(df)
    names = preferred_columns(rows)
    kept, dropped = split_constant_columns(numeric_features(rows, names), names)
    options = {"series_column": series_column, "row_bound": row_bound, "spread": spread}
    return series_records(rows, kept, horizon=horizon, **options), series_records(rows, kept, **options), kept, dropped


def sequence_dataset(
    df: DataFrame, *, context: int, horizon: int, series_column: str | None = schemas.SERIES,
    row_bound: int | None = None, spread: bool | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, list[str], list[str]]:
    """Encoder/decoder samples of all series: (training windows, validation windows, rejected series, kept, dropped).

    Series need `context + horizon + 1` rows. Training stops `horizon` rows before the end of a series; its
    validation sample is the last full window. The target comes normalised per series as well.
    """
    rows = with_target(df)
    names = preferred_columns(rows)
    kept, dropped = split_constant_columns(rows, names)
    panel = indexed_panel(rows, kept, series_column=series_column, row_bound=row_bound, spread=spread)
    panel, rejected = series.reject_short(panel, ["series_id"], context + horizon + 1)
    ends = panel.groupBy("series_id").agg(F.max("time_idx").alias("__last"))
    panel = sizing.attach_lookup(panel, ends, ["series_id"])
    scaled = normalise_target(panel.where(F.col("time_idx") <= F.col("__last") - horizon))
    values = [schemas.TARGET, *kept]
    options = {"context": context, "horizon": horizon, "row_bound": row_bound, "spread": spread}
    training = series.encoder_decoder_windows(
        scaled.withColumnRenamed("time_idx", "__at"), ["series_id"], ["__at"], [f"{schemas.TARGET}_normalised", *values], **options
    )
    tail = panel.where(F.col("time_idx") > F.col("__last") - context - horizon)
    validation = series.encoder_decoder_windows(
        tail.withColumnRenamed("time_idx", "__at"), ["series_id"], ["__at"], values, context=context, horizon=horizon, spread=False
    )
    return training, validation.drop("time_idx"), rejected, kept, dropped
