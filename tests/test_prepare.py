"""Training-table preparation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.operators import prepare
from gridweave.sources import writers


@pytest.fixture(scope="module")
def gold(spark):
    start = F.timestamp_seconds(F.lit(1_700_000_000) - F.lit(1_700_000_000) % 1800 + F.col("id") * 1800)
    return spark.range(40).select(
        F.when(F.col("id") < 30, "a").otherwise("b").alias("dataset_name"), start.alias("interval_start_utc"),
        (F.col("id") % 48 + 1).cast("int").alias("settlement_period"), F.to_date(start).alias("settlement_date"),
        F.when(F.col("id") != 5, F.col("id") * 10).cast("int").alias("demand_mw"),
        F.when(F.col("id") % 2 == 0, F.col("id") / 2).alias("temperature_2m"), F.lit(7).alias("relative_humidity_2m"),
        F.lit(float("nan")).alias("wind_speed_10m"), F.lit(True).alias("flagged"), F.lit("x").alias("note"),
    )


def test_column_choice(gold):
    assert prepare.numeric_columns(gold, schemas.FORECAST_EXCLUDED) == ["settlement_period", "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "flagged"]
    assert "demand_mw" in prepare.numeric_columns(gold, schemas.ANOMALY_EXCLUDED)
    assert prepare.preferred_columns(gold) == ["settlement_period", "temperature_2m", "relative_humidity_2m", "wind_speed_10m"]
    with pytest.raises(ValueError):
        prepare.numeric_columns(gold.select("note"), [])
    with pytest.raises(KeyError):
        prepare.with_target(gold.drop("demand_mw"))


def test_constant_columns(spark):
    frame = spark.sql("SELECT * FROM VALUES (1, 5, NULL, NULL, 2), (2, 5, 7, NULL, 2), (1, 5, 7, NULL, NULL) AS t(a, b, c, d, e)")
    assert prepare.split_constant_columns(frame, ["a", "b", "c", "d", "e"]) == (["a", "c", "e"], ["b", "d"])
    assert prepare.split_constant_columns(frame, []) == ([], [])


def test_feature_filling_and_alignment(spark):
    frame = spark.sql("SELECT * FROM VALUES (1, NULL, 'x', CAST('NaN' AS DOUBLE)), (2, 3.5, '4', 1.0D) AS t(a, b, c, d)")
    filled = prepare.numeric_features(frame, ["a", "b", "c", "d"]).orderBy("a").collect()
    assert [tuple(r) for r in filled] == [(1.0, 0.0, 0.0, 0.0), (2.0, 3.5, 4.0, 1.0)]
    aligned = prepare.align_features(frame, ["missing", "b"]).collect()
    assert aligned[0].missing == 0.0 and None in [r.b for r in aligned]


def test_panel(gold):
    panel = prepare.indexed_panel(gold, ["temperature_2m"]).orderBy("series_id", "time_idx").collect()
    assert len(panel) == 39
    assert [r.time_idx for r in panel if r.series_id == "b"] == list(range(10))
    single = prepare.indexed_panel(gold, [], series_column=None).orderBy("time_idx").collect()
    assert single[-1].time_idx == 38 and {r.series_id for r in single} == {"gb_demand"}


def test_inference_panel(gold):
    rows = prepare.inference_panel(gold, ["settlement_period", "absent"], context=4, horizon=2).orderBy("series_id", "time_idx").collect()
    series_a = [r for r in rows if r.series_id == "a"]
    assert [r.is_decoder for r in series_a] == [False] * 28 + [True] * 2
    assert series_a[5].demand_mw == 0.0 and series_a[0].absent == 0.0
    tail = gold.withColumn("demand_mw", F.lit(None).cast("int"))
    decoder = prepare.inference_panel(tail, [], context=4, horizon=2).where("is_decoder").collect()
    assert {r.demand_mw for r in decoder} == {None}
    with pytest.raises(Exception, match="at least 60"):
        prepare.inference_panel(gold, [], context=50, horizon=10).collect()


def test_repeat_to_minimum(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert sorted(r.k for r in prepare.repeat_to_minimum(frame, 8, ["k"]).collect()) == ["a", "a", "a", "b", "b", "b", "c", "c"]
    assert prepare.repeat_to_minimum(frame, 3, ["k"]).count() == 3
    with pytest.raises(ValueError):
        prepare.repeat_to_minimum(frame.where("k = 'z'"), 8, ["k"])


@pytest.mark.parametrize("spread", [False, True])
def test_series_records(gold, spread):
    train = {r.dataset_name: r for r in prepare.series_records(gold, ["settlement_period", "wind_speed_10m"], horizon=4, spread=spread).collect()}
    assert train["a"].target == [i * 10.0 for i in range(26) if i != 5]
    assert train["b"].target == [i * 10.0 for i in range(30, 36)]
    assert train["a"].dynamic_feat[0][:3] == [1.0, 2.0, 3.0] and set(train["a"].dynamic_feat[1]) == {0.0}
    start = gold.agg(F.min("interval_start_utc")).first()[0]
    assert train["a"].start == start.strftime("%Y-%m-%d %H:%M:%S")
    bare = prepare.series_records(gold, []).first().asDict()
    assert "dynamic_feat" not in bare


def test_long_series_continue_in_segments(gold):
    parts = prepare.series_records(gold.where("dataset_name = 'a'"), [], points=10).orderBy("segment").collect()
    assert [len(p.target) for p in parts] == [10, 10, 9]
    assert sum((p.target for p in parts), []) == [i * 10.0 for i in range(30) if i != 5]
    assert parts[1].start > parts[0].start


def test_horizon_longer_than_series(gold):
    with pytest.raises(Exception, match="horizon"):
        prepare.series_records(gold, [], horizon=10).collect()


def test_json_lines(spark, gold, tmp_path):
    writers.write_json_lines(prepare.series_records(gold, ["settlement_period"]), str(tmp_path / "out"))
    assert list((tmp_path / "out").glob("*.json.gz"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_group_normaliser(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("flat", 5.0), ("flat", 5.0)], "series_id string, demand_mw double")
    rows = {(r.series_id, r.demand_mw): r for r in prepare.normalise_target(frame).collect()}
    assert rows["a", 3.0].demand_mw_normalised == 1.0 and rows["a", 3.0].target_mean == 2.0
    assert rows["flat", 5.0].target_scale == 1.0 and rows["flat", 5.0].demand_mw_normalised == 0.0


@pytest.mark.parametrize("spread", [False, True])
def test_series_channels(gold, spread):
    train, test, kept, dropped = prepare.series_channels(gold, 4, spread=spread)
    assert kept == ["settlement_period", "temperature_2m"] and dropped == ["relative_humidity_2m", "wind_speed_10m"]
    sizes = lambda df: {r.dataset_name: (len(r.target), len(r.dynamic_feat)) for r in df.collect()}
    assert sizes(train) == {"a": (25, 2), "b": (6, 2)} and sizes(test) == {"a": (29, 2), "b": (10, 2)}


@pytest.mark.parametrize("spread", [False, True])
def test_sequence_dataset(gold, spread):
    training, validation, rejected, kept, dropped = prepare.sequence_dataset(gold, context=8, horizon=3, spread=spread)
    assert "settlement_period" in kept and "relative_humidity_2m" in dropped
    assert [(r.series_id, r.row_count, r.required_rows) for r in rejected.collect()] == [("b", 10, 12)]
    assert training.count() == 26 - 11 + 1
    last = validation.collect()
    assert len(last) == 1 and last[0].demand_mw_decoder == [270.0, 280.0, 290.0]
    assert len(training.first().demand_mw_normalised_encoder) == 8
