"""The parallel scan against one pass in order, and moving averages against known ones."""

import random

import numpy as np
import pytest

from gridweave.models import recurrence, seasonal


def in_order(inputs, weights, lags, start):
    y = list(start)
    for u in inputs:
        y.append(u + sum(w * y[-lag] for w, lag in zip(weights, lags, strict=True)))
    return y[len(start):]


@pytest.mark.parametrize("chunk_blocks", [1, 3, 1000])
@pytest.mark.parametrize("lags", [(1, 2, 7), (5,), (1,)])
def test_scan_equals_one_pass(spark, lags, chunk_blocks):
    draw = random.Random(5)
    lengths = {"long": 203, "short": 3, "block": 7, "one": 1, "nothing known": 20, "": 64}
    rows, starts, expected = [], [], {}
    for name, n in lengths.items():
        inputs = [draw.uniform(-1, 1) for _ in range(n)]
        weights, start = [draw.uniform(-0.4, 0.5) for _ in lags], [draw.uniform(-1, 1) for _ in range(max(lags))]
        rows += [(name, 3 * t, u, "x") for t, u in enumerate(inputs)]  # gaps in time do not matter
        if name != "nothing known":
            starts.append((name, weights, start))
            expected |= {(name, 3 * t): y for t, y in enumerate(in_order(inputs, weights, lags, start))}
        else:
            expected |= {(name, 3 * t): None for t in range(n)}
    df = spark.createDataFrame(rows, "site string, t int, u double, value string").repartition(5)
    begins = spark.createDataFrame(starts, "site string, weights array<double>, start array<double>")
    out = recurrence.recur(df, begins, ["site"], ["t"], "u", lags, out="y", chunk_blocks=chunk_blocks)
    assert out.columns == ["site", "t", "u", "value", "y"]
    found = {(r["site"], r["t"]): r["y"] for r in out.collect()}
    assert set(found) == set(expected)
    for key, y in expected.items():
        assert found[key] is None if y is None else found[key] == pytest.approx(y, abs=1e-9)
    assert recurrence.recur(df.limit(0), begins, ["site"], ["t"], "u", lags, out="y").count() == 0


def test_one_series_over_many_tasks(spark, small_tasks):
    draw = np.random.default_rng(1)
    inputs = draw.normal(size=500)
    df = spark.createDataFrame([("s", k, float(u)) for k, u in enumerate(inputs)], "site string, t int, u double")
    begins = spark.createDataFrame([("s", [0.5, 0.2, 0.2], [1.0] * 48)], "site string, weights array<double>, start array<double>")
    out = recurrence.recur(df, begins, ["site"], ["t"], "u", (1, 2, 48), chunk_blocks=1)
    found = [r["value"] for r in out.orderBy("t").collect()]
    assert found == pytest.approx(in_order(inputs, [0.5, 0.2, 0.2], (1, 2, 48), [1.0] * 48), abs=1e-9)


def moving_average(n, seed):
    shocks = np.random.default_rng(seed).normal(0, 3, n + 49)
    y = [100.0] * 49
    for t in range(49, n + 49):
        y.append(20 + 0.5 * y[-1] + 0.3 * y[t - 48] + shocks[t] + 0.6 * shocks[t - 1])
    return y[49:]


def test_moving_average_is_found_and_used(spark):
    n = 6000
    y = moving_average(n, 2)
    panel = spark.createDataFrame([("s", k, float(v), 1.0) for k, v in enumerate(y)], "series_id string, time_idx long, demand_mw double, x double")
    train, test = panel.where(f"time_idx < {n - 100}"), panel.where(f"time_idx >= {n - 100}")
    fit = seasonal.fit_seasonal(train, [])
    row = fit.first()
    assert row["coefficients"][1] == pytest.approx(0.5, abs=0.1) and row["coefficients"][-2] == pytest.approx(0.6, abs=0.12)
    out = seasonal.forecast_seasonal(train, test, fit, [], chunk_blocks=1).orderBy("time_idx").collect()
    # One pass in order, shocks of the future being 0.
    c, shocks, known = row["coefficients"], row["shocks"], list(y[:n - 100])
    for h in range(100):
        echo = [shocks.get(h - k, 0.0) for k in (1, 48)]
        known.append(c[0] + c[1] * known[-1] + c[2] * known[-2] + c[3] * known[-48] + c[4] * echo[0] + c[5] * echo[1])
    assert [r["prediction"] for r in out] == pytest.approx(known[-100:], abs=1e-8)
    assert abs(shocks[-1]) > 0 and min(shocks) == -48
    short = seasonal.fit_seasonal(panel.where("time_idx < 3"), []).first()
    assert len(short["coefficients"]) == 6 and short["coefficients"][-2:] == [0.0, 0.0]
