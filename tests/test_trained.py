"""Scorers trained in passes: what the passes must not lose."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.models import linear, trained


@pytest.fixture(scope="module")
def curve(spark):
    """Rows on a bent line with a few off it."""
    draw = np.random.default_rng(3)
    rows = []
    for k in range(600):
        t = draw.uniform(-2, 2)
        off = 6.0 if k % 60 == 0 else 0.0
        rows.append((k, float(t), float(np.tanh(2 * t) + draw.normal(0, 0.02) + off), float(t * t * 0.1 + draw.normal(0, 0.02)), 1.0))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, same double").withColumn(
        "interval_start_utc", F.timestamp_seconds(F.col("id") * 1800)).drop("id")


def test_gradient_is_that_of_the_error():
    draw = np.random.default_rng(1)
    points, weights = draw.normal(size=(7, 4)), draw.normal(size=4 * 2 + 2 + 4 * 2 + 4)
    value = trained.error_and_gradient(points, weights, 4, 2)
    for k in range(len(weights)):
        step = np.zeros(len(weights))
        step[k] = 1e-6
        slope = (trained.error_and_gradient(points, weights + step, 4, 2)[0] - trained.error_and_gradient(points, weights - step, 4, 2)[0]) / 2e-6
        assert value[1 + k] == pytest.approx(slope, rel=1e-4, abs=1e-5)


def test_encoder_is_no_worse_than_the_linear_form(spark, curve, tmp_path):
    encoder, metrics, errors = trained.train_encoder(curve, latent=1, passes=12)
    plain, _ = linear.train_reconstruction(curve, latent=1)
    mean = lambda df: df.agg(F.avg("anomaly_score")).first()[0]
    assert errors[0] <= mean(plain.scores(curve)) * 1.05 and errors[-1] < errors[0] and all(a >= b for a, b in zip(errors, errors[1:]))
    assert mean(encoder.scores(curve)) == pytest.approx(errors[-1], rel=1e-6)
    assert metrics.first()["detected_anomaly_rows"] == 30
    encoder.save(spark, str(tmp_path / "e"))
    again = trained.Encoder.load(spark, str(tmp_path / "e"))
    assert mean(again.scores(curve)) == pytest.approx(errors[-1], rel=1e-9) and again.threshold == encoder.threshold


def test_boundary_leaves_its_share_outside(curve):
    boundary, metrics, margins = trained.train_nu_boundary(curve, nu=0.1, passes=6)
    row = metrics.first()
    assert row["detected_anomaly_rows"] == 60 and margins[-1] >= margins[0]
    flagged = boundary.score(curve).where("is_anomaly").where("b > 4").count()
    assert flagged == 10  # every row off the line
