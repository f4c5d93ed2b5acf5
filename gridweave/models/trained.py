"""Scorers that are trained in passes over the table: a one-class boundary with a share of outliers, and an encoder that is not linear.

A pass is one Spark job: tasks sum gradients over their rows, and only sums as wide as the model reach the driver. The number of passes is
bounded and documented; what the rows look like does not change it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.models import linear, scoring
from gridweave.operators import prepare
from gridweave.session import stage

#: Share of rows outside the boundary; passes of the two trainings.
NU, BOUNDARY_PASSES, ENCODER_PASSES = 0.05, 12, 24


def summed(table: DataFrame, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows `x` of what `part` makes of a batch of them, a vector of `width` numbers."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width)
        for batch in batches:
            if len(batch):
                total = total + part(np.stack(batch["x"].to_numpy()))
        yield pd.DataFrame({"position": np.arange(width), "total": total})

    rows = table.mapInPandas(run, "position int, total double").groupBy("position").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(width)
    for row in rows:
        out[row["position"]] = row["total"]
    return out


def train_nu_boundary(
    gold: DataFrame, *, nu: float = NU, size: int = 256, seed: int = 42, passes: int = BOUNDARY_PASSES, row_bound: int | None = None, spread: bool | None = None
) -> tuple[linear.OneClassBoundary, DataFrame, list[float]]:
    """The one-class machine that leaves a share `nu` of the rows outside: (boundary, metrics, margin before and after each pass).

    Over random Fourier features the machine is the shortest mean of features in which no row weighs more than 1 / (nu rows). Starting
    from the plain mean, each pass goes towards the mean of the `nu` rows that lie farthest out, by the best step between the two
    (conditional gradient); passes end early when nothing is left to gain.
    """
    prepare.require_rows(gold)
    features = prepare.numeric_columns(gold, schemas.ANOMALY_EXCLUDED)
    means, deviations = linear.column_stats(prepare.repeat_to_minimum(gold, 16, [schemas.EVENT_TIME]), features)
    gamma = 1.0 / max(sum(d > 0 for d in deviations), 1)
    project = linear.fourier_map(len(features), gamma, size, seed)
    table = stage(gold.select(linear.standard_array(gold, features, means, deviations).alias("x")), "features")

    def mean_of(keep: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            made = project(pd.Series(list(x)))
            kept = keep(made)
            return np.append(made[kept].sum(axis=0), kept.sum())

        sums = summed(table, part, size + 1)
        return sums[:-1] / max(sums[-1], 1.0)

    def border(centre: np.ndarray) -> float:
        """The likeness that a share `nu` of the rows does not reach."""
        @F.pandas_udf("double")
        def likeness(x: pd.Series) -> pd.Series:
            return pd.Series(project(x) @ centre, dtype=float)

        return table.agg(F.percentile_approx(likeness("x"), nu, 10_000)).first()[0]

    centre = mean_of(lambda made: np.ones(len(made), bool))
    margins = []
    for _ in range(passes):
        edge = border(centre)
        margins.append(edge / float(np.linalg.norm(centre)))
        outer = mean_of(lambda made: made @ centre <= edge)
        gain = float(centre @ (centre - outer))
        if gain <= 1e-3 * float(centre @ centre):
            break
        centre = centre + min(1.0, gain / float((centre - outer) @ (centre - outer))) * (outer - centre)
    margins.append(border(centre) / float(np.linalg.norm(centre)))
    boundary = linear.OneClassBoundary(features, means, deviations, gamma, centre.tolist(), seed)
    boundary.threshold, flagged = scoring.fit_threshold(boundary.scores(gold), 1 - nu, scoring.ABOVE, row_bound=row_bound, spread=spread)
    metrics = scoring.anomaly_metrics(flagged, boundary.threshold, algorithm="one_class_nu", bootstrap_rows=scoring.bootstrap_rows(16), features=features)
    return boundary, metrics, margins


@dataclass
class Encoder:
    """Rows squeezed through a few tanh units and rebuilt: `W2 tanh(W1 x + b1) + b2`."""

    features: list[str]
    means: list[float]
    deviations: list[float]
    latent: int
    weights: list[float]
    threshold: float = 0.0

    def scores(self, df: DataFrame) -> DataFrame:
        """Add `anomaly_score`, the mean squared error of the rebuilt row."""
        width, latent, weights = len(self.features), self.latent, np.array(self.weights)

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            if x.empty:
                return pd.Series([], dtype=float)
            points = np.stack(x.to_numpy())
            return pd.Series(((rebuilt(points, weights, width, latent)[1] - points) ** 2).mean(axis=1))

        return df.withColumn("anomaly_score", score(linear.standard_array(df, self.features, self.means, self.deviations)))

    def score(self, df: DataFrame) -> DataFrame:
        return scoring.flag(self.scores(df), self.threshold, scoring.ABOVE)

    def save(self, spark, path: str) -> None:
        scoring.save_metadata(spark, path, {**self.__dict__, "direction": scoring.ABOVE})

    @classmethod
    def load(cls, spark, path: str) -> Encoder:
        meta = scoring.load_metadata(spark, path)
        return cls(**{k: meta[k] for k in cls.__dataclass_fields__})


def layers(weights: np.ndarray, width: int, latent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    a, b = width * latent, width * latent + latent
    return weights[:a].reshape(latent, width), weights[a:b], weights[b:b + a].reshape(width, latent), weights[b + a:]


def rebuilt(points: np.ndarray, weights: np.ndarray, width: int, latent: int) -> tuple[np.ndarray, np.ndarray]:
    into, shift, back, offset = layers(weights, width, latent)
    hidden = np.tanh(points @ into.T + shift)
    return hidden, hidden @ back.T + offset


def error_and_gradient(points: np.ndarray, weights: np.ndarray, width: int, latent: int) -> np.ndarray:
    """Summed squared error of some rows, and its gradient."""
    back = layers(weights, width, latent)[2]
    hidden, again = rebuilt(points, weights, width, latent)
    wrong = again - points
    inner = (2 * wrong @ back) * (1 - hidden**2)
    return np.concatenate(([(wrong**2).sum()], (inner.T @ points).ravel(), inner.sum(axis=0), (2 * wrong.T @ hidden).ravel(), 2 * wrong.sum(axis=0)))


def train_encoder(
    gold: DataFrame, *, latent: int = 8, quantile: float = 0.95, passes: int = ENCODER_PASSES, row_bound: int | None = None, spread: bool | None = None
) -> tuple[Encoder, DataFrame, list[float]]:
    """Fit in `passes` passes, flag above the quantile: (encoder, metrics, mean squared error at the start and after each pass).

    The start is the linear form, its principal components inside the straight part of tanh; a step that does not lower the error is
    taken back and halved, so the error is never above the start's. Constant columns are dropped, the others standardised.
    """
    start, _ = linear.train_reconstruction(gold, latent=latent, quantile=quantile, row_bound=row_bound, spread=spread)
    features, width = start.features, len(start.features)
    components = start.components.pc.toArray().T
    latent = len(components)
    table = stage(gold.select(linear.standard_array(gold, features, start.means, start.deviations).alias("x")), "features")
    rows = table.count()

    def measured(w: np.ndarray) -> tuple[float, np.ndarray]:
        sums = summed(table, lambda x: error_and_gradient(x, w, width, latent), len(w) + 1) / (rows * width)
        return float(sums[0]), sums[1:]

    straight = float(summed(table, lambda x: np.array([((x - x @ components.T @ components) ** 2).sum()]), 1)[0]) / (rows * width)
    # Far rows leave the straight part of tanh: the inner weights shrink until the start is the linear form.
    for small in (0.05, 0.01, 0.002, 0.0005):
        weights = np.concatenate(((small * components).ravel(), np.zeros(latent), (components.T / small).ravel(), np.zeros(width)))
        error, gradient = measured(weights)
        if error <= straight * (1 + 1e-6) + 1e-12:
            break
    # Steps are measured for each weight by what it is made of: inner weights are small, outer ones large.
    scale = np.concatenate((np.full(width * latent + latent, small**2), np.full(width * latent, 1 / small**2), np.ones(width)))
    errors, step, momentum = [error], 0.1, np.zeros(len(weights))
    for _ in range(passes):
        move = 0.8 * momentum - step * scale * gradient
        tried, slope = measured(weights + move)
        if tried < error:
            weights, error, gradient, momentum, step = weights + move, tried, slope, move, step * 1.3
        else:
            momentum, step = np.zeros(len(weights)), step / 3
        errors.append(error)
    encoder = Encoder(features, list(start.means), list(start.deviations), latent, weights.tolist())
    encoder.threshold, flagged = scoring.fit_threshold(encoder.scores(gold), quantile, scoring.ABOVE, row_bound=row_bound, spread=spread)
    metrics = scoring.anomaly_metrics(flagged, encoder.threshold, algorithm="tanh_autoencoder", bootstrap_rows=scoring.bootstrap_rows(64), features=features)
    return encoder, metrics, errors
