"""Forecast metrics, score statistics and exact quantiles."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.operators import sizing
from gridweave.session import stage

BUCKETS = 1024
LARGEST = sys.float_info.max


def mean_absolute_error(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def root_mean_squared_error(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - predicted, 2)))


def r2_score(actual: Column, predicted: Column) -> Column:
    """1 - SSres/SStot over complete pairs; 0 for fewer than two pairs or a constant target."""
    pairs = F.count(actual - predicted)
    total = F.var_pop(F.when(predicted.isNotNull(), actual)) * pairs
    residual = F.sum(F.pow(actual - predicted, 2))
    return F.when((pairs < 2) | (total == 0), F.lit(0.0)).otherwise(1 - F.try_divide(residual, total))


def pair_predictions(actual: DataFrame, predicted: DataFrame, keys: Sequence[str], target: str, prediction: str = "prediction") -> DataFrame:
    """Truth and prediction of the same position side by side; one without the other is an error."""
    truth = actual.select(*keys, F.col(target).cast("double").alias("actual"), F.lit(True).alias("__t"))
    guess = predicted.select(*keys, F.col(prediction).cast("double").alias("predicted"), F.lit(True).alias("__p"))
    lone = F.col("__t").isNull() | F.col("__p").isNull()
    failure = F.raise_error(F.lit("truth and prediction do not cover the same rows")).cast("double")
    return truth.join(guess, list(keys), "full").select(*keys, F.when(lone, failure).otherwise(F.col("actual")).alias("actual"), "predicted")


def forecast_metrics(df: DataFrame, groups: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE, R-squared and number of complete pairs per group, in one partial aggregate."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return df.groupBy(*groups).agg(
        mean_absolute_error(a, p).alias("mae"),
        root_mean_squared_error(a, p).alias("rmse"),
        r2_score(a, p).alias("r2"),
        F.count(a - p).alias("test_rows"),
    )


def safe_scale(stddev: Column) -> Column:
    """Scaling divisor of a column: a zero or missing deviation becomes 1."""
    return F.when(stddev.isNull() | (stddev == 0), F.lit(1.0)).otherwise(stddev)


def standardise(value: Column, mean: Column, stddev: Column) -> Column:
    return (value - mean) / safe_scale(stddev)


def fallback_scale(actual: Column) -> Column:
    """Residual scale used where no rolling deviation exists: max(population stddev, 1)."""
    return F.greatest(F.stddev_pop(actual), F.lit(1.0))


def flag_rate(flagged: Column, rows: Column) -> Column:
    """Share of flagged rows; 0 without rows."""
    return F.when(rows == 0, F.lit(0.0)).otherwise(F.try_divide(flagged, rows))


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    *,
    row_bound: int | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles per group as columns `q0`, `q1`, … in the order asked.

    Groups proven to fit one task use `percentile`, which gathers a group's values. Beyond that the
    order statistics are found by repeatedly narrowing a histogram, in passes that only count. Both forms
    give null quantiles to a group whose values are all null, and sort NaN above infinity.
    """
    groups = list(groups)
    if spread is None:
        spread = not sizing.fits_one_task(df, groups, row_bound)
    if spread:
        return _narrowed_quantiles(df, groups, value, probabilities)
    picks = [F.percentile(value, F.lit(float(p))) for p in probabilities]
    return df.groupBy(*groups).agg(*[q.alias(f"q{i}") for i, q in enumerate(picks)])


def _narrowed_quantiles(df: DataFrame, groups: list[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    # One struct per group as the key: unlike plain null keys, structs with nulls in them match themselves.
    keys = ["__key"]
    source = df.withColumn("__key", F.struct(*groups) if groups else F.struct(F.lit(0).alias("__all")))
    # Equal values collapse before the shuffle, so a much repeated value costs one row per task.
    counted = stage(
        source.select(*keys, F.col(value).cast("double").alias("__v"))
        .where("__v IS NOT NULL").groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n")),
        "value-counts",
    )
    spans = counted.groupBy(*keys).agg(
        F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.sum("__n").alias("__rows"),
        F.count("__v").alias("__values"),
    )
    wanted = F.array(*[
        F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("__rows") - 1)).alias("at"))
        for i, p in enumerate(probabilities)
    ])
    ranks = spans.withColumn("__w", F.explode(wanted)).select(
        *keys, "__lo", "__hi", F.lit(0).cast("bigint").alias("__below"), "__values",
        F.col("__w.i").alias("__i"), F.col("__w.at").alias("__at"),
        F.explode(F.array(F.floor("__w.at"), F.ceil("__w.at"))).alias("__rank"),
    ).distinct()
    found, before = stage(ranks, "ranks"), None
    while left := found.where("__lo < __hi").agg(F.sum("__values")).first()[0]:
        if before is not None and left >= before:
            raise RuntimeError("the histogram of a quantile no longer narrows")
        found, before = stage(_narrow(counted, found, keys, last=left <= sizing.ROWS_PER_TASK), "ranks"), left

    low, high = F.col("__rank") == F.floor("__at"), F.col("__rank") == F.ceil("__at")
    at, lo, hi = F.first("__at"), F.max(F.when(low, F.col("__lo"))), F.max(F.when(high, F.col("__lo")))
    each = found.groupBy("__key", "__i").agg(
        F.when(F.floor(at) == F.ceil(at), lo)
        .otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi).alias("__q")
    )
    picks = [F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(f"q{i}") for i in range(len(probabilities))]
    # Groups without a value have no ranks; they come back with nulls.
    every = source.select("__key").distinct().select(F.col("__key").alias("__every"))
    found_of = each.groupBy("__key").agg(*picks).withColumnRenamed("__key", "__found")
    out = every.join(found_of, F.col("__every").eqNullSafe(F.col("__found")), "left").withColumnRenamed("__every", "__key")
    return out.select(*[F.col(f"__key.{g}") for g in groups], *[f"q{i}" for i in range(len(probabilities))])


def _narrow(counted: DataFrame, ranks: DataFrame, keys: list[str], last: bool) -> DataFrame:
    """One pass: shrink each rank's value range to the histogram bucket that holds it.

    Once few values are left in all ranges together, the `last` pass takes every value for a bucket.
    """
    done = ranks.where("__lo = __hi")
    by_key = ranks.where("__lo < __hi").groupBy(*keys).agg(F.collect_set(F.struct("__lo", "__hi", "__below")).alias("__ranges"))
    # Values that are not finite have buckets of their own; halves keep the width of the widest ranges finite.
    low, high = (F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.col(c))) for c in ("__lo", "__hi"))
    wide = high / 2 - low / 2 > LARGEST / 4
    share = F.when(wide, (F.col("__v") / 2 - low / 2) / (high / 2 - low / 2)).otherwise((F.col("__v") - low) / (high - low))
    scaled = (
        F.when(F.isnan("__v"), F.lit(BUCKETS + 1)).when(F.col("__v") > LARGEST, F.lit(BUCKETS)).when(F.col("__v") < -LARGEST, F.lit(-1))
        .otherwise(F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))).cast("long")
    )
    bucket = F.col("__v") if last else scaled
    buckets = (
        # A key has at most two ranges per probability asked for.
        sizing.attach_lookup(counted, by_key, keys)
        .select(*keys, "__v", "__n", F.explode("__ranges").alias("__r"))
        .select(*keys, "__v", "__n", "__r.__lo", "__r.__hi", "__r.__below")
        .where("__v BETWEEN __lo AND __hi")
        .groupBy(*keys, "__lo", "__hi", "__below", bucket.alias("__bucket"))
        .agg(F.sum("__n").alias("__count"), F.min("__v").alias("__new_lo"), F.max("__v").alias("__new_hi"),
             F.count("__v").alias("__new_values"))
    )
    cumulative = Window.partitionBy(*keys, "__lo", "__hi", "__below").orderBy("__bucket")
    buckets = buckets.withColumn("__upto", F.col("__below") + F.sum("__count").over(cumulative)).withColumn(
        "__from", F.col("__upto") - F.col("__count")
    )
    moved = (
        ranks.where("__lo < __hi").join(buckets, [*keys, "__lo", "__hi", "__below"])
        .where("__rank >= __from AND __rank < __upto")
        .select(*keys, F.col("__new_lo").alias("__lo"), F.col("__new_hi").alias("__hi"),
                F.col("__from").alias("__below"), F.col("__new_values").alias("__values"), "__i", "__at", "__rank")
    )
    return done.unionByName(moved)
