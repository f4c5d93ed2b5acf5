"""Point-in-time joins against a search per row."""

import random
from datetime import datetime, timedelta

import pytest

from gridweave import schemas
from gridweave.operators import asof

START = datetime(2024, 1, 1)


def tables(spark, n=400):
    draw = random.Random(3)
    moment = lambda: draw.choice([None] + [START + timedelta(minutes=draw.randrange(600))] * 20)
    key = lambda: draw.choice(["hot"] * 6 + ["a", "b", None])
    left = [(k, key(), moment(), 1) for k in range(n)]
    right = [(draw.randrange(1000), key() if draw.random() < 0.9 else "only", moment(), draw.choice(["x", None])) for _ in range(n // 2)]
    right += right[:5]
    return left, right, spark.createDataFrame(left, "id int, site string, t timestamp, value int").repartition(5), spark.createDataFrame(right, "rank int, site string, t timestamp, name string").repartition(3)


def expected(left, right, keyed, tolerance):
    out = []
    for number, site, at, _ in left:
        seen = [(t, rank, name or "") for rank, s, t, name in right if at and t and t <= at and (s == site and s is not None or not keyed)]
        best = max(seen, default=None)
        out.append((number, best[1] if best and (tolerance is None or (at - best[0]).total_seconds() <= tolerance) else None))
    return sorted(out)


@pytest.mark.parametrize("tolerance", [None, 600])
@pytest.mark.parametrize("keys", [["site"], []])
@pytest.mark.parametrize("spread", [False, True, None])
def test_as_of(spark, spread, keys, tolerance):
    left, right, a, b = tables(spark)
    out = asof.as_of_join(a, b, keys, "t", "t", ["rank", "name"], ties=["rank", "name"], tolerance_seconds=tolerance, spread=spread)
    assert out.columns == ["id", "site", "t", "value", "rank", "name"]
    assert sorted((r["id"], r["rank"]) for r in out.collect()) == expected(left, right, keys, tolerance)


def test_small_tasks_spread(spark, small_tasks):
    left, right, a, b = tables(spark)
    out = asof.as_of_join(a, b, ["site"], "t", "t", ["rank"])
    assert sorted((r["id"], r["rank"]) for r in out.collect()) == expected(left, right, ["site"], None)


def test_empty_sides(spark):
    _, _, a, b = tables(spark)
    for spread in (False, True):
        assert asof.as_of_join(a.limit(0), b, ["site"], "t", "t", ["rank"], spread=spread).count() == 0
        rows = asof.as_of_join(a, b.limit(0), ["site"], "t", "t", ["rank"], spread=spread).collect()
        assert len(rows) == 400 and all(r["rank"] is None for r in rows)


def test_no_forecast_of_the_future(spark):
    """A forecast that was published after the interval began is never used, also where there is no other."""
    at = START + timedelta(hours=5, minutes=30)
    energy = spark.createDataFrame([("a", at), ("a", at - timedelta(minutes=30)), ("b", at + timedelta(days=1))], "dataset_name string, interval_start_utc timestamp")
    rows = [(10.0, at - timedelta(hours=2)), (20.0, at), (30.0, at + timedelta(seconds=1)), (40.0, None)]
    weather = spark.createDataFrame(
        [(t, 50, 1.0, 51.5, 0.0, "GMT", START + timedelta(hours=5), "2024-01-01", f"p{k}", p) for k, (t, p) in enumerate(rows)],
        "temperature_2m double, relative_humidity_2m int, wind_speed_10m double, latitude double, longitude double, timezone string, "
        "forecast_time_local timestamp, bronze_ingestion_date string, source_object_path string, publish_time_utc timestamp")
    out = asof.join_weather_as_of(energy, weather)
    assert out.columns == ["dataset_name", "interval_start_utc", *schemas.WEATHER_COLUMNS]
    assert {(r["interval_start_utc"], r["temperature_2m"]) for r in out.collect()} == {(at, 20.0), (at - timedelta(minutes=30), 10.0), (at + timedelta(days=1), None)}
