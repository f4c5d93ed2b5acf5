"""Threshold checks, promotion reports and the model registry, over tables of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.functions.aggregates import flag_rate
from gridweave.operators import series, sizing


def thresholds(spark: SparkSession, rows: Sequence[tuple] = tuple(schemas.DEFAULT_THRESHOLDS)) -> DataFrame:
    """`(model_family, check_order, name, metric, comparator, target)`; a fixed handful of rows."""
    return spark.createDataFrame(
        list(rows), "model_family string, check_order int, name string, metric string, comparator string, target double"
    )


def with_anomaly_rate(metrics: DataFrame) -> DataFrame:
    """Add the derived `anomaly_rate`; missing counts read 0."""
    rows = F.coalesce(F.col("training_rows"), F.lit(0))
    flagged = F.coalesce(F.col("detected_anomaly_rows"), F.lit(0))
    return metrics.withColumn("anomaly_rate", flag_rate(flagged, rows))


def threshold_checks(runs: DataFrame, limits: DataFrame) -> DataFrame:
    """One row per run and check of its family: `name, observed, comparator, target, passed`.

    `runs` has `model_family` and the metric columns its family's checks name.
    """
    measured = [c for c in ("training_rows", "mae", "rmse", "r2", "anomaly_rate") if c in runs.columns]
    ids = [c for c in runs.columns if c not in (*measured, "model_family")]
    cells = F.array(*[
        F.struct(
            F.lit(m).alias("metric"),
            (F.coalesce(F.col(m), F.lit(0)) if m == "training_rows" else F.col(m)).cast("double").alias("observed"),
        )
        for m in measured
    ])
    long = runs.select(*ids, "model_family", F.inline(cells))
    joined = long.join(limits, ["model_family", "metric"])  # Spark sends the smaller side where it knows its size
    passed = F.when(F.col("comparator") == ">=", F.col("observed") >= F.col("target")).otherwise(
        F.col("observed") <= F.col("target")
    )
    # A row-count target is compared as a whole number.
    whole = F.floor("target").cast("double")
    passed = F.when(F.col("metric") == "training_rows", F.col("observed") >= whole).otherwise(passed)
    return joined.select(
        *ids, "model_family", "check_order", "name", "observed", "comparator", "target",
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def promotion_report(checks: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per run: ordered checks, overall `passed`, and what to do with the model."""
    check = F.struct("check_order", "name", "observed", "comparator", "target", "passed")
    rolled = checks.groupBy(*ids, "model_family").agg(
        F.bool_and("passed").alias("passed"),
        F.sort_array(F.collect_list(check)).alias("__checks"),  # at most one per check of the family
    )
    return rolled.select(
        *ids, "model_family", "passed",
        F.transform("__checks", lambda c: c.dropFields("check_order")).alias("checks"),
        recommendation(F.col("passed")).alias("recommendation"),
    )


def recommendation(passed: Column) -> Column:
    return F.when(passed, F.lit("approve")).otherwise(F.lit("manual_review"))


def rank_candidates(metrics: DataFrame, families: Sequence[str] = ("model_family",), by: str = "rmse") -> DataFrame:
    """Add `candidate_rank` within each family: lowest error first, a missing error last, ties by run."""
    best = Window.partitionBy(*families).orderBy(F.col(by).asc_nulls_last(), "run_id")
    return metrics.withColumn("candidate_rank", F.row_number().over(best))


def latest_version(registry: DataFrame, groups: Sequence[str] = ("model_group",)) -> DataFrame:
    """Highest version of each model group."""
    return registry.groupBy(*groups).agg(
        F.max_by(F.struct(*registry.columns), "version").alias("__row")
    ).select("__row.*")


def latest_approved(registry: DataFrame, groups: Sequence[str] = ("model_group",)) -> DataFrame:
    """Most recently created approved version of each model group."""
    return registry.where("approval_status = 'Approved'").groupBy(*groups).agg(
        F.max_by(F.struct(*registry.columns), F.struct("created_at", "version")).alias("__row")
    ).select("__row.*")


def register(runs: DataFrame, registry: DataFrame | None = None, *, row_bound: int | None = None) -> DataFrame:
    """New registry rows for `runs(model_group, run_id, created_at, …)`: next versions, pending approval."""
    rows = series.series_index(runs, ["model_group"], ["created_at", "run_id"], name="__n", row_bound=row_bound)
    taken = F.lit(0)
    if registry is not None:
        top = registry.groupBy("model_group").agg(F.max("version").alias("__top"))
        rows, taken = sizing.attach_lookup(rows, top, ["model_group"]), F.coalesce("__top", F.lit(0))
    return rows.select(
        *runs.columns, (F.col("__n") + taken + 1).cast("int").alias("version"),
        F.lit("PendingManualApproval").alias("approval_status"),
    )


def apply_approvals(registry: DataFrame, report: DataFrame, keys: Sequence[str], *, requested: bool | Column = True) -> DataFrame:
    """Approve registry rows whose report passed, only where approval was asked for."""
    wanted = requested if isinstance(requested, Column) else F.lit(requested)
    verdict = report.select(*keys, F.col("passed").alias("__passed"))
    status = F.when(F.col("__passed") & wanted, F.lit("Approved")).otherwise(F.col("approval_status"))
    return registry.join(verdict, list(keys), "left").withColumn("approval_status", status).select(*registry.columns)
