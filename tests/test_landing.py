"""Landing one object per request: layout, retries, failures, and the way back."""

import json
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.operators import silver
from gridweave.sources import landing

# The layout of landed objects.
KEY = "bronze/raw/energy/dt=2024-02-03/run+1%2Fa%2Bb.json"


def requests(spark, *rows):
    return spark.createDataFrame(rows, "source string, request_id string, event_time_utc string, payload string")


def found(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*") if p.is_file() and "_landed" not in p.parts and not p.name.startswith("."))


def test_round_trip_keeps_request_and_path(spark, tmp_path):
    body = {"data": [{"dataset": "d", "startTime": "2024-02-03T00:00:00Z", "settlementPeriod": 1, "demand": 5}]}
    rows = requests(spark, ("/energy/", "run 1/a+b", "2024-02-03T01:02:03Z", json.dumps(body)), ("energy", "ü%41", "2024-02-04T01:02:03Z", json.dumps(body, indent=2)))
    landing.land(rows, str(tmp_path), "/bronze/raw/")
    assert KEY in found(tmp_path) and len(found(tmp_path)) == 2
    assert json.loads((tmp_path / KEY).read_text()) == body
    back = landing.read_landed(spark, str(tmp_path), schemas.BRONZE_ENERGY)
    assert {(r["request_id"], r["source"]) for r in back.collect()} == {("run 1/a+b", "energy"), ("ü%41", "energy")}
    flat = silver.energy_to_silver(back).collect()
    assert {r["source_object_path"] for r in flat} == set(found(tmp_path)) and {r["bronze_ingestion_date"] for r in flat} == {"2024-02-03", "2024-02-04"}


def test_landing_again_changes_nothing(spark, tmp_path):
    rows = requests(spark, *[("s", f"r{k % 7}", "2024-01-01", f'{{"n": {k % 7}}}') for k in range(50)], ("s", None, "2024-01-01", "{}"), ("s", "null", "2024-01-01", None))
    landing.land(rows.repartition(6), str(tmp_path), "p")
    before = {name: (tmp_path / name).read_text() for name in found(tmp_path)}
    landing.land(rows.repartition(2), str(tmp_path), "p")
    assert {name: (tmp_path / name).read_text() for name in found(tmp_path)} == before and len(before) == 8
    assert len(list((tmp_path / "_landed").iterdir())) == 2
    assert sorted(r["n"] for r in landing.read_landed(spark, str(tmp_path), "n int").where("n IS NOT NULL").collect()) == list(range(7))


def test_failed_job_takes_back_what_it_added(tmp_path):
    first = landing.LandingWriter(str(tmp_path))
    first.commit([first.write(iter([Row(key="a/1.json", payload="x")]))])
    job = landing.LandingWriter(str(tmp_path))
    message = job.write(iter([Row(key="a/1.json", payload="x"), Row(key="a/2.json", payload="y")]))
    assert found(tmp_path) == ["a/1.json", "a/2.json"] and (message.new, message.replaced) == (["a/2.json"], 1)
    job.abort([message, None])
    assert found(tmp_path) == ["a/1.json"]


def test_wrong_writes(spark, tmp_path):
    spark.dataSource.register(landing.LandingSource)
    with pytest.raises(Exception, match="key and payload"):
        spark.range(1).write.format("landing").mode("append").save(str(tmp_path))
    with pytest.raises(Exception, match="append"):
        spark.range(1).select(F.lit("k").alias("key"), F.lit("p").alias("payload")).write.format("landing").mode("overwrite").save(str(tmp_path))
