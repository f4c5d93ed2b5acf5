"""Seasonal forecasters for many series at once: autoregression with covariates, and the daily profile."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.functions.aggregates import exact_quantiles, forecast_metrics, pair_predictions
from gridweave.models import recurrence
from gridweave.operators import prepare, series, sizing
from gridweave.session import stage

SEASON = 48
TARGET = schemas.TARGET


def model_orders(rows):
    """(own lags, seasonal lag or 0, seasonal moving average or 0) by training length: a week, three days, or less."""
    if rows >= 7 * SEASON:
        return 2, SEASON, SEASON
    if rows >= 3 * SEASON:
        return 1, SEASON, 0
    return 1, 0, 0


OWN_LAGS, ECHO_LAGS = (1, 2, SEASON), (1, SEASON)


def _with_lags(rows: DataFrame, column: str, lags, name: str, row_bound: int | None, spread: bool | None) -> DataFrame:
    frames = {f"__{name}_{k}": (lambda w, k=k: F.lag(column, k).over(w)) for k in lags}
    return series.row_windows(rows, ["series_id"], ["time_idx"], frames, before=max(lags), row_bound=row_bound, spread=spread, index="time_idx")


def _terms(covariates: list[str]) -> list[Column]:
    """What the long autoregression weighs: constant, own lags, covariates."""
    return [F.lit(1.0), *[F.coalesce(F.col(f"__lag_{k}"), F.lit(0.0)).cast("double") for k in OWN_LAGS], *[F.col(c).cast("double") for c in covariates]]


def _usable(seasonal: Column) -> Column:
    return F.col("__lag_1").isNotNull() & F.col("__lag_2").isNotNull() & (F.col(f"__lag_{SEASON}").isNotNull() | ~seasonal)


def _normal_equations(rows: DataFrame, terms: list[Column], count: str) -> DataFrame:
    width = len(terms)
    return rows.groupBy("series_id").agg(
        F.max(count).alias("rows"),
        F.array(*[F.sum(terms[i] * terms[j]) for i in range(width) for j in range(i, width)]).alias("gram"),
        F.array(*[F.sum(t * F.col(TARGET)) for t in terms]).alias("moment"),
    )


def _solved(sums: DataFrame, width: int, echoes: bool) -> DataFrame:
    @F.pandas_udf("array<double>")
    def solve(rows: pd.Series, gram: pd.Series, moment: pd.Series) -> pd.Series:
        return pd.Series([_solve(n, g, m, width, echoes) for n, g, m in zip(rows, gram, moment, strict=True)])

    return sums.select("series_id", "rows", solve("rows", "gram", "moment").alias("coefficients"))


def _solve(rows, gram, moment, width: int, echoes: bool) -> list[float]:
    own, season, echo = model_orders(rows)
    active = np.ones(width, dtype=bool)
    active[2], active[3] = own >= 2, season > 0
    if echoes:
        active[-1] = echo > 0
    full = np.zeros((width, width))
    full[np.triu_indices(width)] = gram
    full = full + np.triu(full, 1).T
    scale = np.sqrt(np.maximum(np.diag(full), 1e-12))
    system = (full / np.outer(scale, scale))[np.ix_(active, active)]
    answer = np.linalg.lstsq(system, (np.asarray(moment) / scale)[active], rcond=1e-10)[0]
    out = np.zeros(width)
    out[active] = answer / scale[active]
    return out.tolist()


def residual_terms(panel: DataFrame, covariates: list[str], *, row_bound: int | None = None, spread: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(long autoregression by series, rows with `__e`, what it leaves of each row it can predict, and the lags of both).

    `rows` counts a series' rows; the long autoregression is the first of two regressions and has no moving average.
    """
    sizes = panel.groupBy("series_id").agg(F.count(F.lit(1)).alias("__n"))
    lagged = sizing.attach_lookup(_with_lags(panel, TARGET, OWN_LAGS, "lag", row_bound, spread), sizes, ["series_id"])
    terms = _terms(covariates)
    long = stage(_solved(_normal_equations(lagged.where(_usable(F.col("__n") >= 3 * SEASON)), terms, "__n"), len(terms), False), "long-autoregression")
    known = sizing.attach_lookup(lagged, long.select("series_id", F.col("coefficients").alias("__long")), ["series_id"])
    left = known.withColumn("__e", F.when(_usable(F.col("__n") >= 3 * SEASON), F.col(TARGET) - recurrence.dot(F.col("__long"), terms))).drop("__long")
    return long, _with_lags(left, "__e", ECHO_LAGS, "echo", row_bound, spread)


def fit_seasonal(panel: DataFrame, covariates: list[str], *, row_bound: int | None = None, spread: bool | None = None) -> DataFrame:
    """Coefficients per series from training rows `(series_id, time_idx, demand_mw, …)`: constant, own lags, covariates, moving averages.

    Two regressions: what a long autoregression leaves stands for the shocks, whose lags (the last one, and with a week of rows
    the one a day ago) then take part beside the own lags. Spark sums the normal equations by partial aggregation, so a
    series of any length costs the same few numbers; only the small system of each series is solved in Python.
    `long` keeps the first regression, `shocks` the last day of what it leaves. A series too short for the second keeps the first.
    """
    long, rows = residual_terms(panel, covariates, row_bound=row_bound, spread=spread)
    rows = stage(rows, "shocks")
    weekly = F.col("__n") >= 7 * SEASON
    complete = rows.where(F.col("__e").isNotNull() & F.col("__echo_1").isNotNull() & (F.col(f"__echo_{SEASON}").isNotNull() | ~weekly))
    terms = [*_terms(covariates), *[F.coalesce(F.col(f"__echo_{k}"), F.lit(0.0)) for k in ECHO_LAGS]]
    full = _solved(_normal_equations(complete, terms, "__n"), len(terms), True)
    last = rows.where(F.col("time_idx") >= F.col("__n") - SEASON)
    shocks = last.groupBy("series_id").agg(F.map_from_entries(F.collect_list(F.struct((F.col("time_idx") - F.col("__n")).alias("at"), F.coalesce("__e", F.lit(0.0)).alias("e")))).alias("shocks"))
    both = long.select("series_id", "rows", F.col("coefficients").alias("long")).join(full.select("series_id", "coefficients"), "series_id", "left").join(shocks, "series_id", "left")
    return both.select("series_id", "rows", F.coalesce("coefficients", F.concat("long", F.array(*[F.lit(0.0)] * len(ECHO_LAGS)))).alias("coefficients"), "long", "shocks")


def fit_equations(panel: DataFrame, covariates: list[str], *, row_bound: int | None = None, spread: bool | None = None) -> DataFrame:
    """`series_id, term, holds`: whether the fitted errors have no share left in a term, or the term no weight.

    This is what makes the fit one of least squares; it is summed from the rows again, not taken from the solver.
    """
    fitted = fit_seasonal(panel, covariates, row_bound=row_bound, spread=spread).select("series_id", "coefficients")
    _, rows = residual_terms(panel, covariates, row_bound=row_bound, spread=spread)
    complete = F.col("__e").isNotNull() & F.col("__echo_1").isNotNull() & (F.col(f"__echo_{SEASON}").isNotNull() | (F.col("__n") < 7 * SEASON))
    terms = [*_terms(covariates), *[F.coalesce(F.col(f"__echo_{k}"), F.lit(0.0)) for k in ECHO_LAGS]]
    names = ["constant", *[f"lag_{k}" for k in OWN_LAGS], *covariates, *[f"echo_{k}" for k in ECHO_LAGS]]
    known = sizing.attach_lookup(rows.where(complete), fitted, ["series_id"])
    known = known.withColumn("__left", F.col(TARGET) - recurrence.dot(F.col("coefficients"), terms))
    share = [F.abs(F.sum(t * F.col("__left"))) / F.sqrt(F.sum(t * t) * F.sum(F.col(TARGET) * F.col(TARGET))) for t in terms]
    by_term = [F.struct(F.lit(n).alias("term"), ((F.any_value(F.get("coefficients", F.lit(k))) == 0) | F.coalesce(s < 1e-6, F.lit(True))).alias("holds")) for k, (n, s) in enumerate(zip(names, share, strict=True))]
    return known.groupBy("series_id").agg(F.array(*by_term).alias("terms")).select("series_id", F.inline("terms"))


def forecast_seasonal(
    history: DataFrame, future: DataFrame, coefficients: DataFrame, covariates: list[str], *, row_bound: int | None = None, chunk_blocks: int = recurrence.CHUNK_BLOCKS
) -> DataFrame:
    """Step-by-step forecast of `future` rows, each step feeding the next: `series_id, time_idx, prediction`.

    Each series enters with its last 48 known values and shocks; a value before the first one is 0, and so is a shock of the future.
    What a step adds to its lags is known beforehand, so the steps are a linear recurrence, run in chunks (see `recurrence.recur`).
    """
    first = 1 + len(OWN_LAGS)
    numbered = series.series_index(future.select("series_id", "time_idx", *covariates), ["series_id"], ["time_idx"], name="__ahead", row_bound=row_bound)
    given = sizing.attach_lookup(numbered, coefficients.select("series_id", "coefficients", "shocks"), ["series_id"])
    weights, shocks = F.col("coefficients"), F.coalesce("shocks", F.create_map().cast("map<bigint,double>"))
    echo = [F.coalesce(F.try_element_at(shocks, F.col("__ahead") - k), F.lit(0.0)) for k in ECHO_LAGS]
    step = F.get(weights, F.lit(0)) + recurrence.dot(weights, [F.col(c).cast("double") for c in covariates], first) + recurrence.dot(weights, echo, first + len(covariates))
    steps = given.select("series_id", "time_idx", step.alias("__step"))
    recent = series.latest_rows(history.select("series_id", "time_idx", TARGET), ["series_id"], ["time_idx"], SEASON)
    values = recent.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("time_idx", F.col(TARGET).cast("double").alias("y")))).getField("y").alias("known"))
    starts = coefficients.join(values, "series_id").select(
        "series_id", F.slice("coefficients", 2, len(OWN_LAGS)).alias("weights"),
        F.concat(F.array_repeat(F.lit(0.0), SEASON - F.size("known")), "known").alias("start"))
    out = recurrence.recur(steps, starts, ["series_id"], ["time_idx"], "__step", OWN_LAGS, out="prediction", chunk_blocks=chunk_blocks, row_bound=row_bound)
    return out.select("series_id", "time_idx", "prediction")


def train_seasonal(
    gold: DataFrame, *, series_column: str | None = schemas.SERIES, row_bound: int | None = None, spread: bool | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fit on the first four fifths of each series and forecast the rest: (coefficients, forecast, metrics)."""
    covariates = prepare.preferred_columns(gold)
    panel = prepare.indexed_panel(gold, covariates, series_column=series_column, row_bound=row_bound, spread=spread)
    parts = series.chronological_split(
        panel.withColumnRenamed("time_idx", "__at"), ["series_id"], ["__at"], minimum_rows=3, row_bound=row_bound, spread=spread
    ).drop("__at")
    parts = stage(parts, "split")
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    kept, dropped = prepare.split_constant_columns(train, covariates)
    coefficients = stage(fit_seasonal(train.drop("split"), kept, row_bound=row_bound, spread=spread), "coefficients")
    forecast = forecast_seasonal(train, test, coefficients, kept, row_bound=row_bound)
    paired = pair_predictions(test, forecast, ["series_id", "time_idx"], TARGET)
    metrics = forecast_metrics(paired, ["series_id"], "actual", "predicted").join(
        coefficients.select("series_id", F.col("rows").alias("training_rows")), "series_id", "left"
    )
    own = F.when(F.col("training_rows") >= 7 * SEASON, 2).otherwise(1)
    metrics = metrics.select(
        "*",
        F.array(own, F.lit(0), F.lit(1)).alias("order"),
        F.array(*[F.when(F.col("training_rows") >= least * SEASON, v).otherwise(0) for v, least in ((1, 3), (0, 3), (1, 7), (SEASON, 3))]).alias("seasonal_order"),
        F.array(*[F.lit(c) for c in kept]).cast("array<string>").alias("feature_columns"),
        F.array(*[F.lit(c) for c in dropped]).cast("array<string>").alias("dropped_constant_feature_columns"),
        F.lit("seasonal_arx").alias("forecast_algorithm"),
    )
    return coefficients, forecast, metrics


def seasonal_profile(
    history: DataFrame, keys: list[str], *, quantiles=(0.1, 0.5, 0.9), target: str = TARGET,
    row_bound: int | None = None, spread: bool | None = None,
) -> DataFrame:
    """Mean and quantiles of demand per series, half-hour slot and weekend flag."""
    means = history.groupBy(*keys).agg(F.avg(target).alias("mean"))
    bands = exact_quantiles(history, keys, target, quantiles, row_bound=row_bound, spread=spread)
    return means.join(bands, keys)


def profile_forecast(rows: DataFrame, profile: DataFrame, keys: list[str]) -> DataFrame:
    """Give every row to predict the profile of its slot."""
    return sizing.attach_lookup(rows, profile, keys)


def score_sequences(
    df: DataFrame, profile: DataFrame, *, context: int, horizon: int, row_bound: int | None = None, spread: bool | None = None
) -> DataFrame:
    """Horizon forecasts of request sequences of at least `context + horizon` rows per series.

    `profile` is keyed by `series_id`, `settlement_period` and `is_weekend`. Each series' profile is shifted by how
    far its own history lies from it.
    """
    keys = ["series_id", "settlement_period", "is_weekend"]
    panel = prepare.inference_panel(df, keys[1:], context=context, horizon=horizon, row_bound=row_bound, spread=spread)
    known = profile_forecast(panel, profile.withColumns({k: F.col(k).cast("double") for k in keys[1:]}), keys)
    shift = F.avg(F.when(~F.col("is_decoder"), F.col(TARGET) - F.col("mean")))
    shifts = known.groupBy("series_id").agg(F.coalesce(shift, F.lit(0.0)).alias("__shift"))
    ahead = sizing.attach_lookup(known.where("is_decoder"), shifts, ["series_id"])
    bands = [c for c in profile.columns if c == "mean" or c.startswith("q")]
    return ahead.select("series_id", "time_idx", *[(F.col(b) + F.col("__shift")).alias(b) for b in bands])
