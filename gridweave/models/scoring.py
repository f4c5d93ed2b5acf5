"""What all fitted models share: feature vectors, thresholds, metrics rows and persistence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions.aggregates import exact_quantiles
from gridweave.functions.scalars import clean_double, column
from gridweave.session import stage

ABOVE, BELOW = ">", "<"


def feature_array(df: DataFrame, names: Sequence[str]) -> Column:
    """Features in training order; absent columns and missing values read 0, as in training."""
    return F.array(*[clean_double(df, n) if n in df.columns else F.lit(0.0) for n in names])


def feature_vector(df: DataFrame, names: Sequence[str]) -> Column:
    return array_to_vector(feature_array(df, names))


def fit_threshold(
    scored: DataFrame, probability: float, direction: str, *, row_bound: int | None = None, spread: bool | None = None
) -> tuple[float, DataFrame]:
    """Exact quantile of the training scores, and the scores with their flags.

    The scores are computed once and written (one column), since threshold and metrics both read them.
    """
    scores = stage(scored.select("anomaly_score"), "scores")
    threshold = exact_quantiles(
        scores, [], "anomaly_score", [probability], row_bound=row_bound, spread=spread
    ).first()["q0"]
    return threshold, flag(scores, threshold, direction)


def flag(scored: DataFrame, threshold: float, direction: str) -> DataFrame:
    """Add `is_anomaly`; the direction is part of the model (isolation scores flag below, others above)."""
    score = F.col("anomaly_score")
    return scored.withColumn("is_anomaly", score < threshold if direction == BELOW else score > threshold)


def anomaly_metrics(
    flagged: DataFrame, threshold: float, *, algorithm: str, bootstrap_rows: Column, features: Sequence[str],
    dropped: Sequence[str] = (),
) -> DataFrame:
    """One metrics row per training run. `training_rows` counts all rows, before any repetition."""
    return flagged.agg(
        F.avg("anomaly_score").alias("score_mean"),
        F.stddev_pop("anomaly_score").alias("score_std"),
        F.lit(threshold).alias("score_threshold"),
        F.count(F.lit(1)).alias("training_rows"),
        bootstrap_rows.alias("bootstrap_training_rows"),
        F.count_if("is_anomaly").alias("detected_anomaly_rows"),
    ).select(
        "*",
        F.lit(algorithm).alias("anomaly_algorithm"),
        F.array(*[F.lit(n) for n in features]).cast("array<string>").alias("feature_columns"),
        F.array(*[F.lit(n) for n in dropped]).cast("array<string>").alias("dropped_constant_feature_columns"),
    )


def bootstrap_rows(minimum: int) -> Column:
    """Rows a training run uses after tiny tables are repeated up to `minimum`."""
    return F.greatest(F.count(F.lit(1)), F.lit(minimum))


def save_metadata(spark: SparkSession, path: str, metadata: dict) -> None:
    """Sidecar of a saved model: one row with its feature list, threshold and direction."""
    row = {k: v for k, v in metadata.items() if v is not None}
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")


def load_metadata(spark: SparkSession, path: str) -> dict:
    return spark.read.parquet(f"{path}/metadata").first().asDict()
