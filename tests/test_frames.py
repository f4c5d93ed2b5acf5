"""Frames over time without gathering them, sketches, outages and draws of equal rows, against plain computations."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridweave.functions import sketches
from gridweave.models import isolation
from gridweave.operators import frames, ingestion

START = datetime(2024, 1, 1)


def table(spark, n=500):
    draw = random.Random(4)
    rows = [(draw.choice(["hot"] * 8 + ["a", None]), START + timedelta(seconds=draw.randrange(600)), draw.choice([None, *range(50)]), k) for k in range(n)]
    rows += [("hot", None, 5, n), ("lone", START, None, n + 1)] + [("ties", START, k, n + 2 + k) for k in range(40)]
    return spark.createDataFrame(rows, "site string, t timestamp, v int, id int").repartition(4)


@pytest.mark.parametrize(("seconds", "spread", "keys"), [(60, True, ["site"]), (0, True, ["site"]), (100_000, True, ["site"]), (60, False, ["site"]), (45, True, [])])
def test_frames_equal_range_windows(spark, seconds, spread, keys):
    df = table(spark)
    out = frames.dense_time_windows(df, keys, "t", ["v"], seconds=seconds, chunk_rows=17, spread=spread)
    assert out.columns == [*df.columns, "v_sum", "v_count", "v_min", "v_max"]
    w = Window.partitionBy(*keys).orderBy(F.unix_micros("t")).rangeBetween(-seconds * 1_000_000, 0)
    timed = df.where("t IS NOT NULL").select("id", F.sum("v").over(w), F.count("v").over(w), F.min("v").over(w), F.max("v").over(w))
    expected = sorted(map(tuple, timed.collect())) + [(500, None, None, None, None)]
    assert sorted(map(tuple, out.select("id", "v_sum", "v_count", "v_min", "v_max").collect())) == sorted(expected)
    assert frames.dense_time_windows(df.limit(0), keys, "t", ["v"], seconds=seconds, spread=spread).count() == 0


def test_no_task_holds_a_frame(spark, small_tasks):
    """All rows in one frame of one series: what a window's key gathers stays a chunk or a block."""
    n = 3000
    df = spark.range(n).select(F.lit("one").alias("s"), F.timestamp_seconds(F.col("id") / 100).alias("t"), F.col("id").alias("v"))
    indexed = df.select("s", "v", F.col("v").alias("i"))
    summed = frames.prefix_sums(indexed, ["s"], ["v"], index="i", chunk_rows=100)
    assert summed.agg(F.max("__upto_v"), F.count("*")).first() == (n * (n - 1) // 2, n)
    sizes = summed.groupBy(F.floor(F.col("i") / 100)).count().agg(F.max("count")).first()[0]
    assert sizes == 100
    out = frames.dense_time_windows(df, ["s"], "t", ["v"], seconds=3600, chunk_rows=100)
    assert out.agg(F.sum("v_count"), F.max("v_max"), F.max("v_min")).first() == (n * (n + 1) // 2, n - 1, 0)


def test_rows_of_a_time_move_as_one(spark, monkeypatch):
    """Very many rows at few times: sorts and joins over time see a row for each time, and a hot time's rows all find theirs."""
    seen, joined = [], frames.as_of_join

    def counted(left, *rest, **options):
        seen.append(left.count())
        return joined(left, *rest, **options)

    monkeypatch.setattr(frames, "as_of_join", counted)
    days = F.when(F.col("id") % 3 > 0, 7).otherwise((F.col("id") / 3).cast("long") % 40)
    df = spark.range(20_000).select(F.lit("one").alias("s"), F.timestamp_seconds(days * 86_400).alias("t"), F.when(F.col("id") % 11 > 0, F.col("id")).alias("v"), "id")
    out = frames.dense_time_windows(df, ["s"], "t", ["v"], seconds=3 * 86_400, chunk_rows=7, spread=True)
    w = Window.partitionBy("s").orderBy(F.unix_micros("t")).rangeBetween(-3 * 86_400_000_000, 0)
    expected = df.select("id", F.sum("v").over(w), F.count("v").over(w), F.min("v").over(w), F.max("v").over(w))
    assert sorted(map(tuple, out.select("id", "v_sum", "v_count", "v_min", "v_max").collect())) == sorted(map(tuple, expected.collect()))
    assert seen == [40]


def test_sketches_are_close_and_merge(spark):
    df = spark.range(200_000).select((F.col("id") % 5).alias("k"), (F.col("id") % 37).alias("day"), F.pow(F.rand(3), 3).alias("v"))
    df = df.unionByName(spark.createDataFrame([(9, 0, None), (9, 1, float("nan"))], "k long, day long, v double"))
    daily = sketches.quantile_sketches(df, ["k", "day"], "v")
    shares = [0.01, 0.5, 0.99]
    found = {r["k"]: r for r in sketches.quantiles(sketches.merged(daily, ["k"]), shares).collect()}
    assert set(found) == {0, 1, 2, 3, 4, 9} and found[9]["q1"] is None and found[0]["rows"] == 40_000
    for k in range(5):
        for i, share in enumerate(shares):
            below = df.where((F.col("k") == k) & (F.col("v") < found[k][f"q{i}"])).count() / 40_000
            assert abs(below - share) <= 2 * sketches.rank_error()


@pytest.mark.parametrize("spread", [False, True])
def test_outages_by_each_source_cadence(spark, spread):
    at = lambda m: START + timedelta(minutes=m)
    landings = [("a", f"r{k}", at(m)) for k, m in enumerate([0, 30, 60, 200, 230, 400])] + [("b", f"s{k}", at(m)) for k, m in enumerate([0, 300, 1000])] + [("a", "x", None), ("unknown", "y", at(0))]
    registry = spark.createDataFrame([("a", "u", 30), ("b", "u", 360), ("c", "u", 5)], "name string, base_url string, cadence_minutes int")
    out = ingestion.outages(spark.createDataFrame(landings, "source string, request_id string, landed_at timestamp"), registry, spread=spread)
    rows = sorted((r["source"], r["out_since"], r["back_at"], r["back_with"], r["missed_landings"], r["landings_before"]) for r in out.collect())
    assert rows == [("a", at(60), at(200), "r3", 3, 3), ("a", at(230), at(400), "r5", 4, 2), ("b", at(300), at(1000), "s2", 0, 2)]


def test_equal_rows_are_drawn_one_by_one(spark):
    """Few different rows, each very often: every tree still gets a full sample of many of them."""
    n = 40_000
    frame = spark.range(n).select((F.col("id") % 50).cast("double").alias("v"))
    drawn = isolation.tree_samples(frame, ["v"], n, trees=100, sample=128, seed=1).groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("x").alias("different")).collect()
    assert len(drawn) == 100 and min(r["n"] for r in drawn) >= 100 and min(r["different"] for r in drawn) > 30
