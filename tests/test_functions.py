"""Scalar functions, metrics and quantiles."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.functions import aggregates, scalars
from gridweave.operators import ingestion


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_float_text_is_python_text(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 20) for _ in range(3000)]
    values += [0.0, -0.0, 8.9, 40.0, 1e16, 1e15, 123456789012345680.0, 1e-4, 1e-5, 12345678.0, 5e-324, 1.7976931348623157e308]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    rows = frame.select("x", scalars.python_float_text(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == [repr(r.x) for r in rows]
    assert one(spark, scalars.python_float_text(F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("sql, expected", [
    ("true", "1"), ("false", "0"), ("CAST(NULL AS BOOLEAN)", ""), ("40", "40"), ("8.9D", "8.9"), ("'GMT'", "GMT"),
    ("CAST('NaN' AS DOUBLE)", "0.0"), ("CAST(NULL AS STRING)", ""), ("DATE '2026-03-26'", "2026-03-26"),
    ("TIMESTAMP '2026-03-26 19:30:00'", "2026-03-26T19:30:00"), ("TIMESTAMP '2026-03-26 19:30:00.25'", "2026-03-26T19:30:00.250000"),
    ("12345678.0D", "12345678.0"),
])
def test_feature_text(spark, sql, expected):
    frame = spark.sql(f"SELECT {sql} AS x")
    assert frame.select(scalars.feature_text(F.col("x"), frame.schema["x"].dataType).alias("v")).first()["v"] == expected


@pytest.mark.parametrize("sql, expected", [
    ("'2026-03-26T19:30:00'", "2026-03-26T19:30:00Z"), ("'2026-03-26T19:30:00+00:00'", "2026-03-26T19:30:00Z"),
    ("'2026-03-26 19:30:00'", "2026-03-26T19:30:00Z"), ("'2026-03-26T20:30:00+01:00'", "2026-03-26T19:30:00Z"),
    ("TIMESTAMP '2026-03-26 19:30:00'", "2026-03-26T19:30:00Z"), ("TIMESTAMP_NTZ '2026-03-26 19:30:00'", "2026-03-26T19:30:00Z"),
    ("CAST(NULL AS TIMESTAMP)", ""), ("'soon'", ""),
])
def test_feature_timestamp(spark, sql, expected):
    frame = spark.sql(f"SELECT {sql} AS x")
    assert frame.select(scalars.feature_timestamp(F.col("x"), frame.schema["x"].dataType).alias("v")).first()["v"] == expected


def test_record_id(spark):
    frame = spark.sql("SELECT 'forecast_features' AS dataset_name, '2026-03-26T19:30:00+00:00' AS interval_start_utc")
    assert frame.select(scalars.record_id(frame).alias("v")).first()["v"] == "forecast_features|2026-03-26T19:30:00Z"
    assert frame.select(scalars.record_id(frame.drop("dataset_name")).alias("v")).first()["v"] == "unknown|2026-03-26T19:30:00Z"
    null = frame.withColumn("dataset_name", F.lit(None).cast("string"))
    assert null.select(scalars.record_id(null).alias("v")).first()["v"] == "0.0|2026-03-26T19:30:00Z"


def test_keys(spark):
    key = scalars.landing_key("/bronze/raw/", F.lit("energy"), F.lit("request-123"), F.lit("2026-03-24T22:30:00+00:00"))
    assert one(spark, key) == "bronze/raw/energy/dt=2026-03-24/request-123.json"
    quoted = scalars.landing_key("raw", F.lit("energy"), F.lit("a b/c"), F.lit("2026-03-24"))
    assert one(spark, quoted) == "raw/energy/dt=2026-03-24/a+b%2Fc.json"
    report = scalars.report_key("/reports/forecast/", F.lit("forecast"), F.lit(3), F.lit("20260325203000"))
    assert one(spark, report) == "reports/forecast/forecast/model_package_version=3/20260325203000.json"


def test_missing_series_start_is_an_error(spark):
    with pytest.raises(Exception, match="interval_start_utc"):
        one(spark, scalars.series_start_text(F.lit(None).cast("timestamp")))


def test_sources(spark):
    assert [(r.name, r.cadence_minutes) for r in ingestion.sources(spark).collect()] == [("elexon-bmrs", 30), ("open-meteo", 30)]


def test_metrics(spark):
    frame = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("a", 5.0, 3.0), ("one", 4.0, 4.0), ("flat", 2.0, 1.0), ("flat", 2.0, 3.0)], "g string, y double, p double")
    rows = {r.g: r for r in aggregates.forecast_metrics(frame, ["g"], "y", "p").collect()}
    assert rows["a"].mae == 1.0 and rows["a"].rmse == pytest.approx(math.sqrt(5 / 3)) and rows["a"].r2 == pytest.approx(1 - 5 / 8)
    assert rows["one"].r2 == 0.0 and rows["flat"].r2 == 0.0
    assert rows["one"].test_rows == 1


def test_rates_and_scales(spark):
    assert one(spark, aggregates.flag_rate(F.lit(4), F.lit(96))) == 4 / 96
    assert one(spark, aggregates.flag_rate(F.lit(4), F.lit(0))) == 0.0
    assert spark.range(1).agg(aggregates.fallback_scale(F.col("id")).alias("v")).first()["v"] == 1.0
    assert one(spark, aggregates.safe_scale(F.lit(0.0))) == 1.0


@pytest.mark.parametrize("shape", ["uniform", "ties", "heavy", "single"])
def test_spread_quantiles_are_exact(spark, monkeypatch, shape):
    monkeypatch.setattr(aggregates, "BUCKETS", 64)
    monkeypatch.setattr(aggregates.sizing, "ROWS_PER_TASK", 20)
    rng = np.random.default_rng(5)
    values = {
        "uniform": rng.uniform(-5, 5, 700), "ties": np.repeat([1.0, 2.0, 7.5], [400, 5, 295]),
        "heavy": np.exp(rng.normal(0, 12, 700)), "single": np.array([3.25]),
    }[shape]
    data = [("g", float(v)) for v in values] + [(None, float(v)) for v in values[:50]] + [("g", None)]
    frame = spark.createDataFrame(data, "k string, v double")
    probabilities = [0.0, 0.05, 0.5, 0.95, 1.0]
    out = {r.k: r for r in aggregates.exact_quantiles(frame, ["k"], "v", probabilities, spread=True).collect()}
    for key, held in (("g", values), (None, values[:50])):
        assert [out[key][f"q{i}"] for i in range(5)] == pytest.approx(list(np.quantile(held, probabilities)), rel=1e-12)
    total = aggregates.exact_quantiles(frame, [], "v", [0.5], spread=True).first()
    plain = aggregates.exact_quantiles(frame, [], "v", [0.5], spread=False).first()
    assert total.q0 == pytest.approx(plain.q0, rel=1e-12)


def test_quantiles_of_nothing(spark):
    assert aggregates.exact_quantiles(spark.createDataFrame([], "v double"), [], "v", [0.5], spread=True).count() == 0


@pytest.mark.parametrize("spread", [False, True])
def test_quantiles_of_odd_values(spark, small_tasks, spread):
    """Both plans give the same rows and schema with null groups, null keys, ties and values that are not finite."""
    inf, nan = float("inf"), float("nan")
    rows = [("a", None), ("a", None), (None, 1.0), (None, 3.0), (None, 8.0)]
    rows += [("b", v) for v in (-inf, 1.0, inf, 2.0, nan, 5e-324, -1.7e308, 1.7e308)]
    rows += [("c", float(k % 50)) for k in range(300)] + [("c", inf), ("c", -inf)]
    frame = spark.createDataFrame(rows, "g string, v double")
    got = aggregates.exact_quantiles(frame, ["g"], "v", [0.0, 0.3, 0.5, 1.0], spread=spread)
    out = {r["g"]: [r[f"q{i}"] for i in range(4)] for r in got.collect()}
    assert got.dtypes == [("g", "string"), *[(f"q{i}", "double") for i in range(4)]]
    assert out["a"] == [None] * 4 and out[None] == pytest.approx([1.0, 2.2, 3.0, 8.0])
    held = sorted(v for g, v in rows if g == "c")
    assert out["c"][0] == -inf and out["c"][3] == inf
    assert out["c"][2] == pytest.approx((held[150] + held[151]) / 2)
    assert out["b"][0] == -inf and math.isnan(out["b"][3]) and out["b"][2] == pytest.approx((1.0 + 2.0) / 2)
    whole = aggregates.exact_quantiles(frame.where("g = 'c'"), [], "v", [0.5], spread=spread).collect()
    assert len(whole) == 1 and whole[0]["q0"] == pytest.approx(out["c"][2])


def test_r2_over_complete_pairs(spark):
    frame = spark.createDataFrame([(1.0, 1.5), (2.0, 2.5), (100.0, None)], "y double, p double")
    row = aggregates.forecast_metrics(frame, [], "y", "p").first()
    assert row["test_rows"] == 2 and row["r2"] == pytest.approx(0.0) and row["mae"] == pytest.approx(0.5)
