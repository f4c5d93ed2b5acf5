"""Row-count proofs, hot keys and joins that stay balanced when one key dominates.

Every operator with a per-key group follows the same rule: where the row count is proven to fit one
task the plain Spark plan is used; beyond it an exact plan without large groups takes over.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.session import stage

ROWS_PER_TASK = 2_000_000
BROADCAST_ROWS = 200_000
NULL_PARTS = 1 << 20  # rows without a key have no partners, so nothing is repeated for their parts


def fits_one_task(df: DataFrame, keys: Sequence[str], row_bound: int | None = None) -> bool:
    """True when no group of `keys` can exceed `ROWS_PER_TASK`.

    `row_bound` is an upper bound on the rows of any one group that the caller has proven (such as the row
    count of the table `df` aggregates). Without it the rows are counted, first in all, then by group.
    """
    if row_bound is not None:
        return row_bound <= ROWS_PER_TASK
    if df.count() <= ROWS_PER_TASK:
        return True
    return bool(keys) and largest_group(df, keys) <= ROWS_PER_TASK


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group; reads the key columns only and combines before the shuffle."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def hot_keys(df: DataFrame, keys: Sequence[str], parts: str) -> DataFrame:
    """Keys with more rows than one task takes, and into how many parts (column `parts`) their rows go."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > ROWS_PER_TASK).select(*keys, F.ceil(F.col("__n") / ROWS_PER_TASK).cast("int").alias(parts))


def attach_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], row_bound: int | None = None) -> DataFrame:
    """Left-join a table with unique `keys`: broadcast where its size is known to be small, else balanced.

    Without a bound the table is computed once, written, and counted from its files.
    """
    if row_bound is None:
        lookup = stage(lookup, "lookup")
        row_bound = lookup.count()
    if row_bound <= BROADCAST_ROWS:
        return df.join(F.broadcast(lookup), list(keys), "left")
    return balanced_left_join(df, lookup, keys)


def balanced_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    left_bound: int | None = None,
    right_bound: int | None = None,
    force: bool = False,
) -> DataFrame:
    """`left.join(right, keys, "left")` without a hot task.

    Where no key can be hot this is the plain join, and Spark picks its strategy from measured sizes.
    Otherwise hot keys are found first and both sides carry two salts: a side's own hot keys are divided
    by a hash of the row into as many parts as they fill tasks, and the other side repeats its rows of those keys
    once per part, so each pair of rows still meets exactly once. Rows with a null key match nothing and are spread as well. Rows that are
    identical in every column share a salt; Silver rows differ at least in the file they came from.
    """
    keys = list(keys)
    if not force and fits_one_task(left, keys, left_bound) and fits_one_task(right, keys, right_bound):
        return left.join(right, keys, "left")

    hot = hot_keys(left, keys, "__ls").join(hot_keys(right, keys, "__rs"), keys, "full")
    hot = hot.select(*keys, F.coalesce("__ls", F.lit(1)).alias("__ls"), F.coalesce("__rs", F.lit(1)).alias("__rs"))
    hot = F.broadcast(stage(hot, "hot-keys"))  # one small row for each `ROWS_PER_TASK` rows of input at most

    def salted(df: DataFrame, divided: str, repeated: str, marker: Column) -> DataFrame:
        keyless = reduce(or_, [F.col(k).isNull() for k in keys])
        parts = F.when(keyless, NULL_PARTS).otherwise(F.coalesce(divided, F.lit(1)))
        copies = F.coalesce(repeated, F.lit(1))
        salts = {
            divided: F.pmod(F.xxhash64(*df.columns), parts).cast("int"),
            repeated: F.explode(F.sequence(F.lit(0), copies - 1)),
        }
        return df.join(hot, keys, "left").select(
            *df.columns, marker, salts["__ls"].alias("__l"), salts["__rs"].alias("__r")
        )

    wide = salted(left, "__ls", "__rs", (F.coalesce("__rs", F.lit(1)) > 1).alias("__repeated"))
    narrow = salted(right, "__rs", "__ls", F.lit(True).alias("__hit"))
    # A repeated row has partners by definition; where one of its salts found none, that copy is no result.
    joined = wide.join(narrow, [*keys, "__l", "__r"], "left").where(~F.col("__repeated") | F.col("__hit").isNotNull())
    return joined.drop("__l", "__r", "__repeated", "__hit")
