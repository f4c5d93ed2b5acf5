"""Quantiles from mergeable sketches: one small summary per part of a table, kept and merged instead of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 800


def rank_error(size: int = SIZE) -> float:
    """Largest error of a rank, as a share of the rows, that a sketch of this size exceeds one time in a hundred (Karnin, Lang, Liberty 2016)."""
    return 2.296 / size**0.9021


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, *, size: int = SIZE) -> DataFrame:
    """A sketch of the values of each key, as a table to keep: `keys, sketch, rows`. Nulls and NaN are not counted.

    Keys name the parts that later sums are made of, such as a series and a date; each task sends one sketch per key.
    """
    number = F.col(value).cast("double")
    held = F.when(~F.isnan(number), number)
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(held, F.lit(size)).alias("sketch"), F.count(held).alias("rows"))


def merged(sketches: DataFrame, keys: Sequence[str], *, size: int = SIZE) -> DataFrame:
    """Sketches of coarser keys from those of finer ones, without the rows."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"), F.sum("rows").alias("rows"))


def quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Add `q0`, `q1`, …: for each probability a value of the table whose rank is off by `rank_error` at most, as a rule. Null without values."""
    def at(p: float) -> Column:
        return F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))))

    return sketches.select("*", *[at(p).alias(f"q{i}") for i, p in enumerate(probabilities)])
