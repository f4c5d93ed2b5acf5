"""Fitted models: small samples with known answers, persistence, and batch scoring."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridweave.models import boosting, isolation, linear, scoring, seasonal
from gridweave.operators import gold, series

START = 1_700_006_400


@pytest.fixture(scope="module")
def table(spark):
    """Ten days of half-hourly demand with a daily wave, mild noise and one spike."""
    slot = F.col("id") % 48
    noise = F.pmod(F.xxhash64("id"), F.lit(21)) - 10
    demand = (1000 + 200 * F.sin(slot * 2 * np.pi / 48) + noise).cast("int")
    rows = spark.range(480).select(
        F.lit("gb").alias("dataset_name"), F.timestamp_seconds(F.lit(START) + F.col("id") * 1800).alias("interval_start_utc"),
        (slot + 1).cast("int").alias("settlement_period"), F.when(F.col("id") == 400, 5000).otherwise(demand).alias("demand_mw"),
        (10 + F.cos(slot / 7.0)).alias("temperature_2m"), F.lit(1.0).alias("latitude"),
    )
    wide = gold.add_calendar(rows)
    wide = series.row_windows(wide, ["dataset_name"], ["interval_start_utc"], gold.lag_and_rolling() | gold.rolling_deviation(), before=48)
    return gold.add_deviation_ratios(wide).cache()


def spike(scored):
    return scored.where("demand_mw = 5000").first()


def test_mean_below_five_rows(spark, table):
    tiny = table.orderBy("interval_start_utc").limit(4)
    model, metrics = boosting.train_forecast(tiny)
    row = metrics.first()
    assert model.algorithm == "mean" and (row.training_rows, row.test_rows) == (3, 1)
    assert row.r2 == 0.0


def test_boosted_forecast_round_trip(spark, table, tmp_path):
    model, metrics = boosting.train_forecast(table.where("demand_mw < 5000"), trees=15)
    row = metrics.first()
    assert (row.training_rows, row.test_rows) == (383, 96) and row.mae < 150 and row.forecast_algorithm == "gradient_boosting"
    assert "demand_mw" not in row.feature_columns and "lag_48_demand_mw" in row.feature_columns
    model.save(spark, str(tmp_path / "m"))
    again = boosting.DemandModel.load(spark, str(tmp_path / "m"))
    thin = table.drop("temperature_2m")
    pairs = model.predict(table).select("prediction").collect(), again.predict(table).select("prediction").collect()
    assert pairs[0] == pairs[1]
    assert again.predict(thin).where("prediction IS NULL").count() == 0


def test_residual_scorer(spark, table):
    scorer, metrics = boosting.train_residual(table, trees=10)
    row = metrics.first()
    assert row.training_rows == 480 and row.bootstrap_training_rows == 384 and row.detected_anomaly_rows == 24
    assert row.anomaly_algorithm == "residual_scoring" and row.regression_algorithm == "gradient_boosting"
    out = spike(scorer.score(table))
    assert out.is_anomaly and out.anomaly_score > scorer.threshold
    bare = scorer.score(table.drop("rolling_stddev_48_demand_mw", "demand_mw"), batch_scale=True).first()
    assert bare.anomaly_score == pytest.approx(abs(bare.predicted_demand_mw))
    with pytest.raises(ValueError):
        boosting.train_residual(table.limit(2))


def test_isolation_forest(spark, table, tmp_path):
    forest, metrics = isolation.train_isolation(table, trees=50)
    row = metrics.first()
    assert row.training_rows == row.bootstrap_training_rows == 480 and row.detected_anomaly_rows == 24
    out = spike(forest.score(table))
    assert out.is_anomaly and out.anomaly_score == forest.scores(table).agg(F.min("anomaly_score")).first()[0]
    repeat, _ = isolation.train_isolation(table.repartition(5), trees=50)
    order = ["tree", "node"]
    pd.testing.assert_frame_equal(
        forest.nodes.sort_values(order).reset_index(drop=True), repeat.nodes.sort_values(order).reset_index(drop=True)
    )
    assert forest.nodes.groupby("tree").size().max() <= 2 * 256 - 1
    forest.save(spark, str(tmp_path / "f"))
    again = isolation.IsolationForest.load(spark, str(tmp_path / "f"))
    assert spike(again.score(table)).anomaly_score == pytest.approx(out.anomaly_score)


def test_isolation_scores_follow_the_formula(spark, table):
    forest, _ = isolation.train_isolation(table, trees=7)
    row = table.limit(1)
    x = row.select(scoring.feature_array(row, forest.features).alias("x")).first().x
    depths = []
    for _, tree in forest.nodes.groupby("tree"):
        nodes = tree.set_index("node")
        at = 0
        while nodes.loc[at, "feature"] >= 0:
            at = nodes.loc[at, "left" if x[int(nodes.loc[at, "feature"])] <= nodes.loc[at, "cut"] else "right"]
        depths.append(nodes.loc[at, "path"])
    c = 2 * (np.log(255) + np.euler_gamma) - 2 * 255 / 256
    assert forest.scores(row).first().anomaly_score == pytest.approx(-(2 ** (-np.mean(depths) / c)))


def test_tree_samples_are_bounded(spark):
    frame = spark.range(20_000).select(F.col("id").cast("double").alias("v"))
    for trees, sample in ((4, 16), (50, 64)):
        counts = isolation.tree_samples(frame, ["v"], 20_000, trees=trees, sample=sample, seed=1).groupBy("tree").count().collect()
        assert len(counts) == trees and all(8 <= r["count"] <= sample for r in counts)


def test_tiny_isolation_table_is_repeated(spark, table):
    _, metrics = isolation.train_isolation(table.limit(3), trees=5)
    assert (metrics.first().training_rows, metrics.first().bootstrap_training_rows) == (3, 8)


def test_one_class_boundary(spark, table, tmp_path):
    boundary, metrics = linear.train_one_class(table, size=2048)
    assert metrics.first().detected_anomaly_rows == 24
    x = np.array(table.select(linear.standard_array(table, boundary.features, boundary.means, boundary.deviations).alias("x")).toPandas()["x"].tolist())
    distances = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    exact = -np.exp(-boundary.gamma * distances).mean(axis=1)
    approx = boundary.scores(table).select("anomaly_score").toPandas()["anomaly_score"].to_numpy()
    assert np.corrcoef(exact, approx)[0, 1] > 0.95
    assert spike(boundary.score(table)).is_anomaly
    boundary.save(spark, str(tmp_path / "b"))
    again = linear.OneClassBoundary.load(spark, str(tmp_path / "b"))
    assert spike(again.score(table)).anomaly_score == pytest.approx(spike(boundary.score(table)).anomaly_score)


def test_reconstruction(spark, table, tmp_path):
    model, metrics = linear.train_reconstruction(table, latent=3)
    row = metrics.first()
    assert "latitude" in row.dropped_constant_feature_columns and row.detected_anomaly_rows == 24
    x = np.array(table.select(linear.standard_array(table, model.features, model.means, model.deviations).alias("x")).toPandas()["x"].tolist())
    _, _, directions = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    rebuilt = x @ directions[:3].T @ directions[:3]
    expected = ((x - rebuilt) ** 2).mean(axis=1)
    actual = model.scores(table).select("anomaly_score").toPandas()["anomaly_score"].to_numpy()
    assert actual == pytest.approx(expected, rel=1e-6, abs=1e-9)
    model.save(spark, str(tmp_path / "r"))
    again = linear.Reconstruction.load(spark, str(tmp_path / "r"))
    assert spike(again.score(table)).anomaly_score == pytest.approx(spike(model.score(table)).anomaly_score)
    with pytest.raises(ValueError, match="constant"):
        linear.train_reconstruction(table.select("interval_start_utc", "latitude"))


@pytest.mark.parametrize("rows, orders", [(335, (1, 48, 0)), (336, (2, 48, 48)), (144, (1, 48, 0)), (143, (1, 0, 0)), (3, (1, 0, 0))])
def test_orders(rows, orders):
    assert seasonal.model_orders(rows) == orders


def autoregressive(n, a, b, s, exog):
    rng = np.random.default_rng(9)
    y = list(rng.normal(100, 10, 48))
    for t in range(48, n):
        y.append(5 + a * y[-1] + b * y[-2] + s * y[t - 48] + 2.0 * exog[t])
    return y


@pytest.mark.parametrize("spread", [False, True])
def test_seasonal_model_recovers_the_recurrence(spark, spread):
    n = 600
    exog = np.random.default_rng(4).normal(0, 5, n)
    data = []
    for name, (a, b, s) in {"one": (0.3, 0.2, 0.4), "two": (0.1, -0.2, 0.7)}.items():
        y = autoregressive(n, a, b, s, exog)
        data += [(name, i, float(y[i]), float(exog[i])) for i in range(n)]
    panel = spark.createDataFrame(data, "series_id string, time_idx long, demand_mw double, x double")
    train, test = panel.where("time_idx < 500"), panel.where("time_idx >= 500")
    weights = seasonal.fit_seasonal(train, ["x"], spread=spread)
    one = weights.where("series_id = 'one'").first()
    assert one.rows == 500 and one.coefficients[:5] == pytest.approx([5, 0.3, 0.2, 0.4, 2.0], abs=1e-4)
    out = seasonal.forecast_seasonal(train, test, weights, ["x"]).join(test, ["series_id", "time_idx"]).toPandas()
    assert len(out) == 200 and out["prediction"].to_numpy() == pytest.approx(out["demand_mw"].to_numpy(), rel=1e-3)


def test_seasonal_training(spark, table):
    both = table.unionByName(table.withColumn("dataset_name", F.lit("short")).orderBy("interval_start_utc").limit(60))
    _, forecast, metrics = seasonal.train_seasonal(both.where("demand_mw < 5000"))
    rows = {r.series_id: r for r in metrics.collect()}
    assert (rows["gb"].training_rows, rows["gb"].test_rows, list(rows["gb"].seasonal_order)) == (383, 96, [1, 0, 1, 48])
    assert list(rows["short"].seasonal_order) == [0, 0, 0, 0] and list(rows["gb"].order) == [2, 0, 1]
    assert rows["gb"].mae < 60 and forecast.count() == 96 + 12
    assert "temperature_2m" in rows["gb"].feature_columns


def test_seasonal_profile(spark, table):
    keys = ["dataset_name", "settlement_period", "is_weekend"]
    parts = series.horizon_split(table, ["dataset_name"], ["interval_start_utc"], 48)
    profile = seasonal.seasonal_profile(parts.where("split = 'train'"), keys)
    out = seasonal.profile_forecast(parts.where("split = 'holdout'"), profile, keys).toPandas()
    assert len(out) == 48 and (out["q0"] <= out["q1"]).all() and (out["q1"] <= out["q2"]).all()
    assert (out["demand_mw"] - out["mean"]).abs().mean() < 100


def test_sequence_scoring(spark, table):
    history = table.where("demand_mw < 5000").withColumnRenamed("dataset_name", "series_id")
    profile = seasonal.seasonal_profile(history, ["series_id", "settlement_period", "is_weekend"])
    request = table.where("demand_mw < 5000").orderBy(F.desc("interval_start_utc")).limit(96).withColumn("demand_mw", F.col("demand_mw") + 100)
    out = seasonal.score_sequences(request, profile, context=48, horizon=48).toPandas()
    assert len(out) == 48 and (out["q0"] <= out["q2"]).all()
    assert out["mean"].mean() == pytest.approx(1100, abs=15)
    with pytest.raises(Exception, match="at least 97"):
        seasonal.score_sequences(request, profile, context=49, horizon=48).collect()


def test_unpaired_predictions_are_an_error(spark):
    from gridweave.functions.aggregates import pair_predictions

    truth, guess = spark.sql("SELECT id AS k, 1.0D AS y FROM range(3)"), spark.sql("SELECT id AS k, 2.0D AS prediction FROM range(3)")
    assert pair_predictions(truth, guess, ["k"], "y").count() == 3
    with pytest.raises(Exception, match="same rows"):
        pair_predictions(truth, guess.where("k < 2"), ["k"], "y").collect()


@pytest.mark.parametrize("rows", [50, 4000])
def test_isolation_samples_by_one_rule(spark, rows):
    """Trees get their samples by one rule below and above the number of rows they need."""
    frame = spark.createDataFrame([(float(k),) for k in range(rows)], "x double")
    samples = isolation.tree_samples(frame, ["x"], rows, trees=20, sample=64, seed=1).groupBy("tree").count().collect()
    assert len(samples) == 20 and all(r["count"] == min(rows, 64) for r in samples)
