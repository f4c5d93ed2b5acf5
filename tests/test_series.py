"""Row index, windows, splits: the large-table plans against brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridweave.operators import gold, series, sizing


def table(spark, rows=900, hot_share=0.4, ties=True, seed=7):
    """Several series, one of them with 40 % of the rows, many rows on one timestamp, some exact copies."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        name = "hot" if rng.random() < hot_share else rng.choice(["a", "b", None])
        at = 500 if ties and rng.random() < 0.4 else rng.randrange(1000)
        data.append((name, at, rng.randrange(3) if ties else i, rng.randrange(1000) / 8))
    data += data[:20]
    return spark.createDataFrame(data, "s string, at int, tie int, v double")


@pytest.mark.parametrize("keys", [["s"], []])
def test_spread_index_is_a_gapless_sorted_numbering(spark, keys):
    out = series.series_index(table(spark), keys, ["at", "tie"], size="n", spread=True).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.s if keys else 0, []).append(r)
    for rows in groups.values():
        rows.sort(key=lambda r: r.time_idx)
        assert [r.time_idx for r in rows] == list(range(len(rows)))
        assert {r.n for r in rows} == {len(rows)}
        order = [(r["at"], r.tie) for r in rows]
        assert order == sorted(order)
    assert sum(map(len, groups.values())) == 920


@pytest.mark.parametrize("chunk", [48, 64, 250])
def test_chunked_windows_equal_plain_windows(spark, chunk):
    frame = table(spark, ties=False).withColumn("id", F.monotonically_increasing_id())
    columns = gold.lag_and_rolling("v") | gold.rolling_deviation("v")
    options = dict(series=["s"], order=["at", "tie", "id"], columns=columns, before=48)
    plain = series.row_windows(frame, **options, spread=False)
    cut = series.row_windows(frame, **options, spread=True, chunk_rows=chunk)
    shape = lambda df: sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select("id", *columns).collect()), key=lambda r: r[0]
    )
    assert shape(plain) == shape(cut)


def test_windows_that_look_ahead(spark):
    frame = spark.range(500).select(F.lit("x").alias("s"), F.col("id"))
    ahead = {"next": lambda w: F.sum("id").over(w.rowsBetween(0, 9)), "later": lambda w: F.lead("id", 9).over(w)}
    options = dict(series=["s"], order=["id"], columns=ahead, before=0, after=9)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(series.row_windows(frame, **options, spread=False)) == rows(series.row_windows(frame, **options, spread=True, chunk_rows=16))


def test_frame_must_fit_a_chunk(spark):
    with pytest.raises(ValueError):
        series.row_windows(spark.range(3), [], ["id"], {}, before=48, spread=True, chunk_rows=10)


def test_large_series_are_spread_by_measure(spark, small_tasks):
    frame = table(spark, ties=False).withColumn("id", F.monotonically_increasing_id())
    assert not sizing.fits_one_task(frame, ["s"])
    out = series.chronological_split(frame, ["s"], ["at", "tie", "id"])
    counts = {(r.s, r.split): r["count"] for r in out.groupBy("s", "split").count().collect()}
    sizes = {r.s: r["count"] for r in frame.groupBy("s").count().collect()}
    for name, n in sizes.items():
        assert counts[name, "train"] == int(n * 0.8)
        assert counts[name, "train"] + counts[name, "test"] == n


@pytest.mark.parametrize("n, train, test", [(1, 1, 1), (2, 1, 1), (9, 8, 1), (10, 8, 2), (11, 8, 3), (101, 80, 21)])
@pytest.mark.parametrize("spread", [False, True])
def test_chronological_split_sizes(spark, n, train, test, spread):
    out = series.chronological_split(spark.range(n), [], ["id"], spread=spread)
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert (counts.get("train"), counts.get("test")) == (train, test)
    assert n == 1 or out.where("split = 'train'").agg(F.max("id")).first()[0] == train - 1


def test_horizon_split_and_short_series(spark):
    frame = spark.range(30).select((F.col("id") < 20).alias("s"), "id")
    out = series.horizon_split(frame, ["s"], ["id"], 4)
    assert {(r.s, r.split): r["count"] for r in out.groupBy("s", "split").count().collect()} == {
        (True, "train"): 16, (True, "holdout"): 4, (False, "train"): 6, (False, "holdout"): 4}
    kept, rejected = series.reject_short(frame, ["s"], 15)
    assert kept.count() == 20 and [(r.s, r.row_count) for r in rejected.collect()] == [(False, 10)]


def test_latest_rows(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("s"), "id")
    assert sorted(r.id for r in series.latest_rows(frame, ["s"], ["id"], 2).collect()) == [94, 95, 96, 97, 98, 99]
    assert sorted(r.id for r in series.latest_row(frame, ["s"], ["id"]).collect()) == [97, 98, 99]
    assert [r.id for r in series.latest_row(frame, [], ["id"]).collect()] == [99]
    assert sorted(r.id for r in series.latest_rows_overall(frame, ["id"], 3).collect()) == [97, 98, 99]


@pytest.mark.parametrize("row_bound", [100, 10**9])
def test_many_latest_rows_go_by_index(spark, monkeypatch, row_bound):
    monkeypatch.setattr(series, "GROUP_LIMIT", 2)
    monkeypatch.setattr(series, "TOP_LIMIT", 2)
    frame = spark.range(100).select((F.col("id") % 3).alias("s"), "id")
    assert sorted(r.id for r in series.latest_rows(frame, ["s"], ["id"], 3, row_bound=row_bound).collect()) == list(range(91, 100))
    assert sorted(r.id for r in series.latest_rows_overall(frame, ["id"], 3).collect()) == [97, 98, 99]


@pytest.mark.parametrize("spread", [False, True])
def test_encoder_decoder_windows(spark, spread):
    frame = spark.range(12).select(F.lit("x").alias("s"), "id", (F.col("id") * 10.0).alias("v"))
    out = series.encoder_decoder_windows(frame, ["s"], ["id"], ["v"], context=4, horizon=2, spread=spread).orderBy("time_idx").collect()
    assert len(out) == 7
    assert out[0].v_encoder == [0.0, 10.0, 20.0, 30.0] and out[0].v_decoder == [40.0, 50.0]
    assert out[-1].v_decoder == [100.0, 110.0]


def test_time_windows(spark):
    minutes = [0, 30, 60, 24 * 60, 24 * 60 + 30, 72 * 60]
    frame = spark.createDataFrame([("x", m) for m in minutes], "s string, m int").withColumn("t", F.timestamp_seconds(F.col("m") * 60))
    out = series.time_windows(frame, ["s"], "t", {"n": lambda w: F.count("m").over(w)}, seconds=84_600).orderBy("m").collect()
    assert [r.n for r in out] == [1, 2, 3, 3, 3, 1]


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def skewed(spark, rows, seed, names, column):
    rng = random.Random(seed)
    data = [(names[0] if rng.random() < 0.4 else rng.choice(names), i) for i in range(rows)]
    return spark.createDataFrame(data, f"k string, {column} int")


@pytest.mark.parametrize("left_names, right_names", [
    (["hot", "a", "b", None], ["a", "b", "c"]),       # hot on the left, absent on the right
    (["hot", "a", "b"], ["a", "hot", "c"]),           # hot on the left
    (["a", "hot", "b"], ["hot", "c", "d"]),           # hot on the right
    (["hot", "a", None], ["hot", "a", None]),         # hot on both sides
])
def test_balanced_join_equals_plain_join(spark, small_tasks, left_names, right_names):
    left, right = skewed(spark, 400, 1, left_names, "l"), skewed(spark, 300, 2, right_names, "r")
    assert rows_of(sizing.balanced_left_join(left, right, ["k"])) == rows_of(left.join(right, ["k"], "left"))


def test_balanced_join_of_identical_copies(spark, small_tasks):
    left = spark.range(200).select(F.lit("k").alias("k"), F.lit(1).alias("l")).union(spark.sql("SELECT 'z', 2"))
    right = spark.range(60).select(F.lit("k").alias("k"), F.lit(5).alias("r"))
    assert sizing.balanced_left_join(left, right, ["k"]).count() == 200 * 60 + 1


def test_lookup_join(spark, small_tasks):
    left = skewed(spark, 300, 3, ["hot", "a", "b", "c"], "l")
    lookup = spark.createDataFrame([("hot", 1), ("a", 2), ("b", 3)], "k string, w int")
    assert rows_of(sizing.attach_lookup(left, lookup, ["k"])) == rows_of(left.join(lookup, ["k"], "left"))
    plan = sizing.attach_lookup(left, lookup, ["k"], row_bound=1)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_hot_series_is_spread_over_tasks(spark):
    """The series with most rows must not land in one window task."""
    frame = table(spark, rows=4000, ties=False).withColumn("id", F.monotonically_increasing_id())
    out = series.row_windows(frame, ["s"], ["at", "tie", "id"], {"w": lambda w: F.count("v").over(w.rowsBetween(-47, 0))}, before=48, spread=True, chunk_rows=256)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__chunk" in plan and "SinglePartition" not in plan


def test_gold_windows_without_weather(spark):
    row = lambda i: ("x", i, float(i))
    frame = spark.createDataFrame([row(i) for i in range(60)], "s string, t int, demand_mw double")
    wide = series.row_windows(frame, ["s"], ["t"], gold.lag_and_rolling() | gold.rolling_deviation(), before=48)
    out = gold.add_deviation_ratios(wide).orderBy("t").collect()
    assert out[0].lag_1_demand_mw is None and out[0].rolling_z_score is None and out[0].demand_to_rolling_mean_ratio is None
    assert out[59].lag_48_demand_mw == 11.0 and out[59].rolling_min_48_demand_mw == 12.0
    assert out[59].rolling_mean_48_demand_mw == pytest.approx(35.5)


def test_anomaly_sample_row(spark):
    frame = spark.sql("SELECT 27750 AS demand_mw, 26890.0D AS rolling_mean_48_demand_mw, 850.0D AS rolling_stddev_48_demand_mw")
    row = gold.add_deviation_ratios(frame).first()
    assert row.demand_minus_rolling_mean_mw == 860
    assert row.rolling_z_score == pytest.approx(1.011765, abs=1e-6)
    assert row.demand_to_rolling_mean_ratio == pytest.approx(1.031982, abs=1e-6)


def test_index_is_the_same_in_both_plans(spark, small_tasks):
    rows = [(s, k // 3, k % 2) for s in ("a", None) for k in range(100)]
    frame = spark.createDataFrame(rows, "s string, t int, v int")
    plans = [series.series_index(frame, ["s"], ["t"], size="n", spread=spread) for spread in (False, True)]
    assert plans[0].schema["time_idx"].dataType == plans[1].schema["time_idx"].dataType
    assert sorted(map(str, plans[0].collect())) == sorted(map(str, plans[1].collect()))
