"""Gradient-boosted demand regression and the residual anomaly scorer built on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.functions.aggregates import forecast_metrics
from gridweave.functions.scalars import safe_double
from gridweave.models import scoring
from gridweave.operators import prepare, series
from gridweave.session import stage


@dataclass
class DemandModel:
    """A fitted regressor, or the training mean where there were too few rows."""

    features: list[str]
    mean: float
    trees: GBTRegressionModel | None = None

    @property
    def algorithm(self) -> str:
        return "gradient_boosting" if self.trees else "mean"

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        if self.trees is None:
            return df.withColumn(name, F.lit(self.mean))
        model = self.trees.setFeaturesCol("__features").setPredictionCol(name)
        return model.transform(df.withColumn("__features", scoring.feature_vector(df, self.features))).drop("__features")

    def save(self, spark: SparkSession, path: str) -> None:
        if self.trees:
            self.trees.write().overwrite().save(f"{path}/trees")
        scoring.save_metadata(
            spark, path, {"features": self.features, "mean": self.mean, "has_trees": self.trees is not None}
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DemandModel:
        meta = scoring.load_metadata(spark, path)
        trees = GBTRegressionModel.load(f"{path}/trees") if meta["has_trees"] else None
        return cls(list(meta["features"]), meta["mean"], trees)


def fit_demand(train: DataFrame, features: list[str], *, minimum_rows: int, trees: int = 100, seed: int = 42) -> DemandModel:
    """Boosted trees of depth 3 at learning rate 0.1, or the mean below `minimum_rows`."""
    stats = train.agg(F.count(F.lit(1)).alias("n"), F.avg(schemas.TARGET).alias("mean")).first()
    if stats["n"] < minimum_rows:
        return DemandModel(features, float(stats["mean"]))
    table = train.select(
        F.col(schemas.TARGET).cast("double").alias("label"), scoring.feature_vector(train, features).alias("features")
    )
    return DemandModel(features, float(stats["mean"]), GBTRegressor(maxIter=trees, maxDepth=3, stepSize=0.1, seed=seed).fit(table))


def train_forecast(
    gold: DataFrame, *, excluded=tuple(schemas.FORECAST_EXCLUDED), trees: int = 100, row_bound: int | None = None,
    spread: bool | None = None,
) -> tuple[DemandModel, DataFrame]:
    """Fit on the first four fifths of the timeline, measure on the rest."""
    rows = prepare.with_target(gold)
    features = prepare.numeric_columns(rows, excluded)
    train, test = split_table(rows, features, row_bound=row_bound, spread=spread)
    model = fit_demand(train, features, minimum_rows=5, trees=trees)
    metrics = run_metrics(model, train, test, "forecast_algorithm")
    return model, metrics


def split_table(
    rows: DataFrame, features: list[str], *, row_bound: int | None = None, spread: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows of the whole timeline: target and features only, written once for the passes of a fit."""
    order = [c for c in (schemas.EVENT_TIME, schemas.SERIES, "settlement_period") if c in rows.columns]
    parts = series.chronological_split(rows, [], order, row_bound=row_bound, spread=spread)
    parts = stage(prepare.numeric_features(parts, features, keep=[schemas.TARGET, "split"]), "split")
    return parts.where("split = 'train'"), parts.where("split = 'test'")


def run_metrics(model: DemandModel, train: DataFrame, test: DataFrame, tag: str) -> DataFrame:
    measured = forecast_metrics(model.predict(test), [], schemas.TARGET, "prediction")
    return measured.select(
        "*", F.lit(train.count()).alias("training_rows"), F.lit(model.algorithm).alias(tag),
        F.array(*[F.lit(n) for n in model.features]).alias("feature_columns"),
    )


@dataclass
class ResidualScorer:
    """Distance of demand from its prediction, in units of the rolling deviation."""

    model: DemandModel
    scale: float
    threshold: float

    def residuals(self, df: DataFrame, *, batch_scale: bool = False) -> DataFrame:
        """Add `predicted_demand_mw` and `anomaly_score`. Missing demand or deviation reads 0."""
        actual = safe_double(F.col(schemas.TARGET)) if schemas.TARGET in df.columns else F.lit(0.0)
        name = "rolling_stddev_48_demand_mw"
        deviation = safe_double(F.col(name)) if name in df.columns else F.lit(0.0)
        predicted = self.model.predict(df, "predicted_demand_mw")
        scale = self.scale
        if batch_scale:
            scale = max(df.agg(F.stddev_pop(actual)).first()[0] or 0.0, 1.0)
        unit = F.when(deviation > 0, deviation).otherwise(F.lit(scale))
        return predicted.withColumn("anomaly_score", F.abs(actual - F.col("predicted_demand_mw")) / unit)

    def score(self, df: DataFrame, *, batch_scale: bool = False) -> DataFrame:
        return scoring.flag(self.residuals(df, batch_scale=batch_scale), self.threshold, scoring.ABOVE)


def train_residual(
    gold: DataFrame, *, trees: int = 100, row_bound: int | None = None, spread: bool | None = None
) -> tuple[ResidualScorer, DataFrame]:
    """Fit the demand model, then set the threshold at the 95th percentile of all residual scores."""
    rows = prepare.with_target(gold)
    features = prepare.numeric_columns(rows, [*schemas.ANOMALY_EXCLUDED, schemas.TARGET])
    whole = rows.agg(F.count(F.lit(1)), F.stddev_pop(schemas.TARGET)).first()
    if whole[0] < 3:
        raise ValueError("at least three rows are required for residual scoring")
    train, test = split_table(rows, features, row_bound=row_bound, spread=spread)
    model = fit_demand(train, features, minimum_rows=32, trees=trees)
    scorer = ResidualScorer(model, max(whole[1], 1.0), 0.0)
    scorer.threshold, flagged = scoring.fit_threshold(
        scorer.residuals(rows), 0.95, scoring.ABOVE, row_bound=row_bound, spread=spread
    )
    metrics = scoring.anomaly_metrics(
        flagged, scorer.threshold, algorithm="residual_scoring", bootstrap_rows=F.lit(train.count()), features=features
    )
    fit = run_metrics(model, train, test, "regression_algorithm").first()
    names = ("mae", "rmse", "r2", "test_rows", "regression_algorithm")
    return scorer, metrics.withColumns({name: F.lit(fit[name]) for name in names})
