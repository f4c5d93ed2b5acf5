"""Standardised scorers: kernel one-class boundary and linear reconstruction error."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.functions.aggregates import standardise
from gridweave.functions.scalars import clean_double, column
from gridweave.models import scoring
from gridweave.operators import prepare


def column_stats(df: DataFrame, names: list[str]) -> tuple[list[float], list[float]]:
    """Mean and population deviation of every feature, in one pass."""
    values = [clean_double(df, n) for n in names]
    row = df.agg(*[F.avg(v) for v in values], *[F.stddev_pop(v) for v in values]).first()
    return list(row[: len(names)]), list(row[len(names):])


def standard_array(df: DataFrame, names: list[str], means: list[float], deviations: list[float]):
    cells = [clean_double(df, n) if n in df.columns else F.lit(0.0) for n in names]
    return F.array(*[standardise(c, F.lit(m), F.lit(s)) for c, m, s in zip(cells, means, deviations)])


@dataclass
class OneClassBoundary:
    """Similarity to the mean kernel feature (random Fourier features, Rahimi & Recht 2007)."""

    features: list[str]
    means: list[float]
    deviations: list[float]
    gamma: float
    centre: list[float]
    seed: int
    threshold: float = 0.0

    def scores(self, df: DataFrame) -> DataFrame:
        """Add `anomaly_score`, the negated mean similarity; higher is stranger."""
        project, centre = fourier_map(len(self.features), self.gamma, len(self.centre), self.seed), np.array(self.centre)

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(-(project(x) @ centre), dtype=float)

        return df.withColumn("anomaly_score", score(standard_array(df, self.features, self.means, self.deviations)))

    def score(self, df: DataFrame) -> DataFrame:
        return scoring.flag(self.scores(df), self.threshold, scoring.ABOVE)

    def save(self, spark, path: str) -> None:
        scoring.save_metadata(spark, path, {**self.__dict__, "direction": scoring.ABOVE})

    @classmethod
    def load(cls, spark, path: str) -> OneClassBoundary:
        meta = scoring.load_metadata(spark, path)
        return cls(**{k: meta[k] for k in cls.__dataclass_fields__})


def fourier_map(width: int, gamma: float, size: int, seed: int):
    """Random cosine features whose inner products approximate exp(-gamma |x - y|^2)."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(0.0, np.sqrt(2.0 * gamma), (width, size))
    shift = rng.uniform(0.0, 2.0 * np.pi, size)

    def project(x: pd.Series) -> np.ndarray:
        if x.empty:
            return np.empty((0, size))
        return np.sqrt(2.0 / size) * np.cos(np.stack(x.to_numpy()) @ weights + shift)

    return project


def train_one_class(
    gold: DataFrame, *, size: int = 256, seed: int = 42, row_bound: int | None = None, spread: bool | None = None
) -> tuple[OneClassBoundary, DataFrame]:
    """One pass for the scale, one for the mean feature, then the 95th percentile of the scores."""
    prepare.require_rows(gold)
    features = prepare.numeric_columns(gold, schemas.ANOMALY_EXCLUDED)
    means, deviations = column_stats(prepare.repeat_to_minimum(gold, 16, [schemas.EVENT_TIME]), features)
    # Standardised columns have variance 1, constant ones 0.
    gamma = 1.0 / max(sum(d > 0 for d in deviations), 1)
    project = fourier_map(len(features), gamma, size, seed)

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(size), 0
        for batch in batches:
            total, rows = total + project(batch["x"]).sum(axis=0), rows + len(batch)
        yield pd.DataFrame({"position": np.arange(size), "total": total, "rows": rows})

    table = gold.select(standard_array(gold, features, means, deviations).alias("x"))
    sums = table.mapInPandas(partial_sums, "position int, total double, rows long")
    centre = sums.groupBy("position").agg((F.sum("total") / F.sum("rows")).alias("mean")).orderBy("position")
    boundary = OneClassBoundary(features, means, deviations, gamma, [r["mean"] for r in centre.collect()], seed)
    boundary.threshold, flagged = scoring.fit_threshold(
        boundary.scores(gold), 0.95, scoring.ABOVE, row_bound=row_bound, spread=spread
    )
    metrics = scoring.anomaly_metrics(
        flagged, boundary.threshold, algorithm="one_class_kernel",
        bootstrap_rows=scoring.bootstrap_rows(16), features=features,
    )
    return boundary, metrics


@dataclass
class Reconstruction:
    """Error of rebuilding a row from its principal components: the best linear autoencoder."""

    features: list[str]
    means: list[float]
    deviations: list[float]
    components: PCAModel
    threshold: float = 0.0

    def scores(self, df: DataFrame) -> DataFrame:
        """Add `anomaly_score`, the mean squared error. Components are orthonormal, so it is |x|^2 - |z|^2."""
        x = standard_array(df, self.features, self.means, self.deviations)
        squared = lambda values: F.aggregate(values, F.lit(0.0), lambda total, v: total + v * v)
        projected = self.components.setInputCol("__x").setOutputCol("__z").transform(
            df.withColumn("__x", array_to_vector(x))
        )
        error = (squared(vector_to_array("__x")) - squared(vector_to_array("__z"))) / len(self.features)
        return projected.withColumn("anomaly_score", F.greatest(error, F.lit(0.0))).drop("__x", "__z")

    def score(self, df: DataFrame) -> DataFrame:
        return scoring.flag(self.scores(df), self.threshold, scoring.ABOVE)

    def save(self, spark, path: str) -> None:
        self.components.write().overwrite().save(f"{path}/components")
        meta = {k: v for k, v in self.__dict__.items() if k != "components"}
        scoring.save_metadata(spark, path, {**meta, "direction": scoring.ABOVE})

    @classmethod
    def load(cls, spark, path: str) -> Reconstruction:
        meta = scoring.load_metadata(spark, path)
        return cls(meta["features"], meta["means"], meta["deviations"], PCAModel.load(f"{path}/components"), meta["threshold"])


def train_reconstruction(
    gold: DataFrame, *, latent: int = 8, quantile: float = 0.95, row_bound: int | None = None, spread: bool | None = None
) -> tuple[Reconstruction, DataFrame]:
    """Drop constant columns, standardise, keep `latent` components, flag above the quantile."""
    prepare.require_rows(gold)
    numeric = prepare.numeric_columns(gold, schemas.ANOMALY_EXCLUDED)
    features, dropped = prepare.split_constant_columns(gold, numeric)
    if not features:
        raise ValueError("all numeric feature columns are constant")
    training = prepare.repeat_to_minimum(gold, 64, [schemas.EVENT_TIME])
    means, deviations = column_stats(training, features)
    vectors = training.select(array_to_vector(standard_array(training, features, means, deviations)).alias("x"))
    size = max(1, min(latent, len(features) - 1))
    model = Reconstruction(features, means, deviations, PCA(k=size, inputCol="x", outputCol="z").fit(vectors))
    model.threshold, flagged = scoring.fit_threshold(
        model.scores(gold), quantile, scoring.ABOVE, row_bound=row_bound, spread=spread
    )
    metrics = scoring.anomaly_metrics(
        flagged, model.threshold, algorithm="linear_autoencoder",
        bootstrap_rows=scoring.bootstrap_rows(64), features=features, dropped=dropped,
    )
    return model, metrics
