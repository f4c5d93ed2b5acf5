"""Bronze documents to Silver rows."""

import datetime as dt
import json

import pytest

from gridweave import schemas
from gridweave.operators import silver
from gridweave.plans import medallion
from gridweave.sources import readers, writers

ENERGY = {"data": [{
    "dataset": "ITSDO", "publishTime": "2026-03-24T23:00:00Z", "startTime": "2026-03-24T22:30:00Z",
    "settlementDate": "2026-03-24", "settlementPeriod": 46, "demand": 27615,
}]}
WEATHER = {
    "latitude": 51.51147, "longitude": -0.13078308, "generationtime_ms": 0.11, "utc_offset_seconds": 0,
    "timezone": "GMT", "timezone_abbreviation": "GMT", "elevation": 16.0,
    "hourly_units": {"time": "iso8601", "temperature_2m": "C", "relative_humidity_2m": "%", "wind_speed_10m": "km/h"},
    "hourly": {
        "time": ["2026-03-24T00:00", "2026-03-24T01:00", "2026-03-24T02:00", "2026-03-24T03:00"],
        "temperature_2m": [10.7, 10.3, 10.3, 10.1], "relative_humidity_2m": [71, 77, 78, 83],
        "wind_speed_10m": [13.7, 16.2, 17.3, 15.8],
    },
}


def land(root, source, date, name, payload):
    folder = root / source / (f"dt={date}" if date else "undated")
    folder.mkdir(parents=True, exist_ok=True)
    text = payload if isinstance(payload, str) else json.dumps(payload, indent=2)
    (folder / f"{name}.json").write_text(text, encoding="utf-8")


def energy(spark, root, **options):
    return silver.energy_to_silver(readers.read_bronze_energy(spark, str(root / "energy")), **options)


def test_demand_record(spark, tmp_path):
    land(tmp_path, "energy", "2026-03-24", "a", ENERGY)
    row = energy(spark, tmp_path).first()
    assert (row.dataset_name, row.settlement_period, row.demand_mw) == ("ITSDO", 46, 27615)
    assert row.interval_start_utc == dt.datetime(2026, 3, 24, 22, 30)
    assert row.interval_end_utc == row.publish_time_utc == dt.datetime(2026, 3, 24, 23, 0)
    assert row.settlement_date == dt.date(2026, 3, 24)
    assert row.bronze_ingestion_date == "2026-03-24"
    assert row.source_object_path.endswith("/energy/dt=2026-03-24/a.json")


@pytest.mark.parametrize("payload", [{"data": []}, {"data": None}, {}, {"data": [None]}])
def test_empty_payloads_give_no_rows(spark, tmp_path, payload):
    land(tmp_path, "energy", "2026-03-24", "a", payload)
    assert energy(spark, tmp_path).count() == 0


def test_unreadable_values_become_null(spark, tmp_path):
    record = ENERGY["data"][0] | {"startTime": "soon", "settlementDate": "later", "demand": "many"}
    land(tmp_path, "energy", None, "a", {"data": [record, ENERGY["data"][0]]})
    rows = energy(spark, tmp_path).orderBy("interval_start_utc").collect()
    assert [r.demand_mw for r in rows] == [None, 27615]
    assert rows[0].interval_start_utc is rows[0].interval_end_utc is rows[0].settlement_date is None
    assert {r.bronze_ingestion_date for r in rows} == {None}
    assert {r.bronze_ingestion_date for r in energy(spark, tmp_path, empty_date_as_null=False).collect()} == {""}


def test_weather_arrays(spark, tmp_path):
    land(tmp_path, "weather", "2026-03-24", "a", WEATHER)
    rows = silver.weather_to_silver(readers.read_bronze_weather(spark, str(tmp_path / "weather"))).orderBy("forecast_time_local").collect()
    assert [(r.temperature_2m, r.relative_humidity_2m, r.wind_speed_10m) for r in rows] == [
        (10.7, 71, 13.7), (10.3, 77, 16.2), (10.3, 78, 17.3), (10.1, 83, 15.8)]
    assert rows[0].forecast_time_local == dt.datetime(2026, 3, 24)
    assert rows[0].forecast_date == dt.date(2026, 3, 24)


def test_short_arrays_pad_with_null(spark, tmp_path):
    hourly = WEATHER["hourly"] | {"temperature_2m": [1.5], "relative_humidity_2m": []}
    land(tmp_path, "weather", "2026-03-24", "a", WEATHER | {"hourly": hourly})
    rows = silver.weather_to_silver(readers.read_bronze_weather(spark, str(tmp_path / "weather"))).orderBy("forecast_time_local").collect()
    assert [r.temperature_2m for r in rows] == [1.5, None, None, None]
    assert {r.relative_humidity_2m for r in rows} == {None}


def test_date_range_scan(spark, tmp_path):
    for day in (23, 24, 25):
        land(tmp_path, "energy", f"2026-03-{day}", "a", ENERGY)
    frame = readers.read_bronze_energy(spark, str(tmp_path / "energy"), dates=("2026-03-24", "2026-03-25"))
    assert silver.energy_to_silver(frame).select("bronze_ingestion_date").distinct().count() == 2


def test_latest_version_wins(spark, tmp_path):
    old, new = ENERGY["data"][0], ENERGY["data"][0] | {"publishTime": "2026-03-25T09:00:00Z", "demand": 28000}
    broken = old | {"startTime": None}
    land(tmp_path, "energy", "2026-03-24", "a", {"data": [old, old, broken]})
    land(tmp_path, "energy", "2026-03-25", "b", {"data": [new, old, broken | {"demand": 5}]})
    kept = silver.latest_energy(energy(spark, tmp_path)).collect()
    assert sorted(r.demand_mw for r in kept if r.interval_start_utc) == [28000]
    assert sorted(r.demand_mw for r in kept if not r.interval_start_utc) == [5, 27615]


def test_latest_weather_per_hour(spark, tmp_path):
    land(tmp_path, "weather", "2026-03-23", "a", WEATHER)
    warmer = WEATHER["hourly"] | {"temperature_2m": [20.0] * 4}
    land(tmp_path, "weather", "2026-03-24", "b", WEATHER | {"hourly": warmer})
    flat = silver.weather_to_silver(readers.read_bronze_weather(spark, str(tmp_path / "weather")))
    assert flat.count() == 8
    assert [r.temperature_2m for r in silver.latest_weather(flat).collect()] == [20.0] * 4


def test_jobs_end_to_end(spark, tmp_path):
    start = dt.datetime(2026, 3, 23)
    for day in range(3):
        records = []
        for period in range(48):
            at = start + dt.timedelta(days=day, minutes=30 * period)
            records.append({
                "dataset": "ITSDO", "publishTime": (at + dt.timedelta(hours=1)).isoformat() + "Z", "startTime": at.isoformat() + "Z",
                "settlementDate": at.date().isoformat(), "settlementPeriod": period + 1, "demand": 20000 + 100 * day + period,
            })
        date = (start + dt.timedelta(days=day)).date().isoformat()
        land(tmp_path, "energy", date, "a", {"data": records})
        land(tmp_path, "energy", date, "again", {"data": records[:10]})
    land(tmp_path, "weather", "2026-03-24", "a", WEATHER)
    land(tmp_path, "weather", "2026-03-25", "b", WEATHER)
    path = lambda name: str(tmp_path / name)
    medallion.bronze_to_silver(spark, path("energy"), path("weather"), path("s_e"), path("s_w"))
    assert readers.read_table(spark, path("s_e")).count() == 3 * 58
    medallion.silver_to_gold(spark, path("s_e"), path("s_w"), path("g_f"), path("g_a"))
    gold = readers.read_gold(spark, path("g_a"), target="demand_mw").orderBy("interval_start_utc").collect()
    assert len(gold) == 144
    assert [r.lag_48_demand_mw for r in gold[47:50]] == [None, 20000, 20001]
    assert sum(r.temperature_2m is not None for r in gold) == 8
    assert gold[0].rolling_stddev_48_demand_mw == 0.0 and gold[0].rolling_z_score is None
    assert set(schemas.ANOMALY_FEATURES) == set(gold[0].asDict())
    newest = readers.read_latest_partition(spark, path("g_f"))
    assert {r.settlement_date for r in newest.select("settlement_date").collect()} == {dt.date(2026, 3, 25)}
    medallion.silver_to_gold(spark, path("s_e"), path("s_w"), path("p_f"), path("p_a"), parity=True)
    # Ten half-hours landed twice on each of three days; both forecasts of the four hours repeat eight of 2026-03-24.
    assert readers.read_table(spark, path("p_a")).count() == 3 * 58 + 16


def test_incremental_write_replaces_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    row = lambda day, n: spark.sql(f"SELECT {n} AS n, DATE '2026-03-{day}' AS settlement_date")
    writers.write_energy_silver(row(24, 1).union(row(25, 2)), path)
    writers.write_energy_silver(row(25, 3), path, incremental=True)
    assert sorted(r.n for r in readers.read_table(spark, path).collect()) == [1, 3]
    writers.write_energy_silver(row(26, 4), path)
    assert [r.n for r in readers.read_table(spark, path).collect()] == [4]


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_gold(spark, str(tmp_path / "absent"))
