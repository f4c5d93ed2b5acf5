"""Evaluation, feature store, payloads, response checks, manifests."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridweave import schemas
from gridweave.models import scoring
from gridweave.operators import evaluation, feature_store, ingestion, payloads
from gridweave.sources import readers, writers

RUN = "run_id string, model_group string, model_family string, training_rows bigint, mae double, rmse double, r2 double, anomaly_rate double"


def report(spark, *rows):
    checks = evaluation.threshold_checks(spark.createDataFrame(rows, RUN), evaluation.thresholds(spark))
    return {r.run_id: r for r in evaluation.promotion_report(checks, ["run_id", "model_group"]).collect()}


def failing(row):
    return [c.name for c in row.checks if not c.passed]


def test_forecast_thresholds(spark):
    out = report(
        spark, ("good", "g", "forecast", 96, 1200.0, 1800.0, 0.71, None), ("bad", "g", "forecast", 12, 5200.0, 8100.0, -0.3, None),
        ("edge", "g", "forecast", 48, 5000.0, 7000.0, 0.0, None), ("empty", "g", "forecast", None, None, 1.0, 1.0, None),
    )
    assert out["good"].passed and out["good"].recommendation == "approve" and len(out["good"].checks) == 4
    assert failing(out["bad"]) == ["min_training_rows", "max_mae", "max_rmse", "min_r2"] and out["bad"].recommendation == "manual_review"
    assert out["edge"].passed
    assert failing(out["empty"]) == ["min_training_rows", "max_mae"]


def test_anomaly_thresholds(spark):
    metrics = spark.createDataFrame([("ok", 96, 4), ("bad", 12, 10), ("none", 0, 0)], "run_id string, training_rows bigint, detected_anomaly_rows bigint")
    rated = evaluation.with_anomaly_rate(metrics)
    assert {r.run_id: r.anomaly_rate for r in rated.collect()} == {"ok": 4 / 96, "bad": 10 / 12, "none": 0.0}
    runs = rated.select("run_id", F.lit("g").alias("model_group"), F.lit("anomaly").alias("model_family"), "training_rows", "anomaly_rate")
    checks = evaluation.threshold_checks(runs, evaluation.thresholds(spark))
    out = {r.run_id: r for r in evaluation.promotion_report(checks, ["run_id"]).collect()}
    assert out["ok"].passed and failing(out["bad"]) == ["min_training_rows", "max_anomaly_rate"]
    assert failing(out["none"]) == ["min_training_rows", "min_anomaly_rate"]


def test_registry(spark):
    runs = spark.sql("""SELECT * FROM VALUES ('m', 'r1', TIMESTAMP '2026-01-01'), ('m', 'r2', TIMESTAMP '2026-01-02'), ('k', 'r3', TIMESTAMP '2026-01-03')
        AS t(model_group, run_id, created_at)""")
    registry = evaluation.register(runs)
    assert {r.run_id: (r.version, r.approval_status) for r in registry.collect()} == {
        "r1": (1, "PendingManualApproval"), "r2": (2, "PendingManualApproval"), "r3": (1, "PendingManualApproval")}
    verdicts = spark.createDataFrame([("r1", True), ("r2", False)], "run_id string, passed boolean")
    approved = evaluation.apply_approvals(registry, verdicts, ["run_id"])
    assert [r.run_id for r in evaluation.latest_approved(approved).collect()] == ["r1"]
    assert {r.run_id for r in evaluation.latest_version(approved).collect()} == {"r2", "r3"}
    assert evaluation.apply_approvals(registry, verdicts, ["run_id"], requested=False).where("approval_status = 'Approved'").count() == 0
    again = evaluation.register(spark.sql("SELECT 'm' AS model_group, 'r4' AS run_id, TIMESTAMP '2026-01-04' AS created_at"), approved)
    assert again.first().version == 3


def test_report_and_metrics_files(spark, tmp_path):
    metrics = spark.createDataFrame([(96, 1.5)], "training_rows bigint, mae double")
    writers.write_metrics(metrics, str(tmp_path / "run"), str(tmp_path / "history"))
    writers.write_metrics(metrics.withColumn("r2", F.lit(0.5)), str(tmp_path / "run2"), str(tmp_path / "history"))
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "evaluation.json").write_text(json.dumps({"training_rows": 7, "mae": 2.0}, indent=2))
    assert readers.read_metrics(spark, str(tmp_path / "plain")).first().training_rows == 7
    history = spark.read.option("mergeSchema", "true").parquet(str(tmp_path / "history"))
    assert sorted(r.r2 is None for r in history.collect()) == [False, True]
    writers.write_reports(spark.sql("SELECT 'forecast' AS model_family, 3 AS model_package_version, true AS passed"), str(tmp_path / "reports"))
    assert list((tmp_path / "reports").glob("model_family=forecast/model_package_version=3/*.json"))


@pytest.fixture(scope="module")
def rows(spark):
    start = F.timestamp_seconds(F.lit(1_774_483_200) + F.col("id") * 1800)  # 2026-03-26
    return spark.range(60).select(
        F.lit("forecast_features").alias("dataset_name"), start.alias("interval_start_utc"), (start + F.expr("INTERVAL 30 MINUTES")).alias("interval_end_utc"),
        (F.col("id") % 48 + 1).cast("int").alias("settlement_period"), F.to_date(start).alias("settlement_date"), F.col("id").cast("int").alias("demand_mw"),
        F.when(F.col("id") < 59, 8.9).alias("temperature_2m"), (F.col("id") % 2 == 0).alias("flagged"), F.lit("GMT").alias("timezone"),
    )


def test_feature_records(spark, rows):
    last = feature_store.feature_records(rows).orderBy(F.desc("interval_start_utc")).first()
    values = {f.FeatureName: f.ValueAsString for f in last.record}
    assert last.record[0].FeatureName == "feature_record_id" and values["feature_record_id"] == "forecast_features|2026-03-27T05:30:00Z"
    assert values["interval_start_utc"] == "2026-03-27T05:30:00Z" and values["settlement_period"] == "12"
    assert values["temperature_2m"] == "0.0" and values["flagged"] == "0" and values["settlement_date"] == "2026-03-27"
    first = feature_store.feature_records(rows).orderBy("interval_start_utc").first()
    assert {f.FeatureName: f.ValueAsString for f in first.record}["temperature_2m"] == "8.9"


def test_feature_group(spark, rows, tmp_path):
    kinds = {"dataset_name": "String", "interval_start_utc": "String", "settlement_period": "Integral", "demand_mw": "Fractional"}
    schema = feature_store.feature_group_schema(schemas.ANOMALY_FEATURES)
    assert len(schema) == 30 and len(feature_store.feature_group_schema(schemas.FORECAST_FEATURES)) == 26
    assert schema["demand_mw"].metadata == {"feature_type": "Fractional"} and schema.names[0] == "feature_record_id"
    typed = feature_store.to_feature_group(rows, kinds)
    assert dict(typed.dtypes)["demand_mw"] == "double" and typed.count() == 60
    assert feature_store.schema_problems(rows, {"timezone": "Integral", "gone": "String"}) == ["gone: missing", "timezone: string is not Integral"]
    with pytest.raises(ValueError):
        feature_store.to_feature_group(rows, {"timezone": "Integral"})
    writers.write_feature_group(typed, str(tmp_path / "store"))
    writers.write_feature_group(typed.limit(5).withColumn("demand_mw", F.lit(-1.0)), str(tmp_path / "store"))
    latest = feature_store.upsert(None, spark.read.parquet(str(tmp_path / "store")))
    assert latest.count() == 60 and latest.where("demand_mw = -1").count() == 5
    assert sorted(r.demand_mw for r in feature_store.select_backfill(rows, 3).collect()) == [57, 58, 59]
    assert feature_store.select_backfill(rows).count() == 60


def test_latest_row_payload(rows):
    out = payloads.payload_for(rows, "baseline", keys=()).first()
    assert json.loads(out.payload) == {"instances": [{"settlement_period": 12, "temperature_2m": 0.0, "flagged": False}]}
    assert out.context.settlement_date == "2026-03-27" and out.context.publish_time_utc == ""
    assert out.context.interval_start_utc == "2026-03-27T05:30:00"
    assert json.loads(payloads.payload_for(rows, "anomaly", keys=()).first().payload)["instances"][0]["demand_mw"] == 59


def test_context_falls_back_to_the_partition(spark):
    frame = spark.sql("SELECT '2026-03-26T18:00:00+00:00' AS interval_start_utc, CAST(NULL AS DATE) AS settlement_date")
    context = frame.select(payloads.context_struct(frame, ["interval_start_utc", "settlement_date"], fallback=F.lit("2026-03-26")).alias("c")).first().c
    assert context.asDict() == {"interval_start_utc": "2026-03-26T18:00:00+00:00", "settlement_date": "2026-03-26"}


def test_sequence_payload(rows):
    out = payloads.sequence_payload(rows, required_rows=4).first()
    assert out.valid and [i["demand_mw"] for i in json.loads(out.payload)["instances"]] == [56.0, 57.0, 58.0, 59.0]
    assert set(json.loads(out.payload)["instances"][0]) == {"settlement_period", "demand_mw", "temperature_2m", "flagged"}
    short = payloads.payload_for(rows, "tft").first()
    assert not short.valid and short.payload is None and short.error == "need at least 96 rows, found 60"


def test_history_future_payload(rows):
    out = payloads.history_future_payload(rows, ["settlement_period", "temperature_2m", "absent"], context=3, horizon=2).first()
    body = json.loads(out.payload)
    assert body["configuration"] == {"num_samples": 100, "output_types": ["mean"]}
    assert body["instances"] == [{"start": "2026-03-27 03:30:00", "target": [55.0, 56.0, 57.0],
                                  "dynamic_feat": [[8.0, 9.0, 10.0, 11.0, 12.0], [8.9, 8.9, 8.9, 8.9, 0.0], [0.0] * 5]}]


FORECAST = {
    '{"predictions": [30871.804249141638]}': True, '{"predictions": [{"mean": [30100.0, 30200.5], "quantiles": {"0.5": [30100.0]}}]}': True,
    '{"predictions": [1, "x"]}': True, '{"predictions": [true]}': True, '{"predictions": []}': False, '{"predictions": 4}': False, "{}": False, "[1]": False,
    '{"predictions": ["4"]}': False, '{"predictions": [null]}': False, '{"predictions": [[1]]}': False, '{"predictions": [{"mean": []}]}': False,
    '{"predictions": [{"mean": [1, null]}]}': False, '{"predictions": [{"mean": 3}]}': False, '{"predictions": [{}]}': False, '{"predictions": [1': False,
}
ANOMALY = {
    '{"predictions": [{"anomaly_score": -0.55, "is_anomaly": false}]}': True, '{"predictions": [{"anomaly_score": 1, "is_anomaly": true, "x": 1}, 3]}': True,
    '{"predictions": [{"anomaly_score": 1}]}': False, '{"predictions": [{"anomaly_score": "1", "is_anomaly": true}]}': False,
    '{"predictions": [{"anomaly_score": 1, "is_anomaly": 1}]}': False, '{"predictions": [1]}': False, '{"predictions": []}': False, "nope": False,
    '{"predictions": [{"anomaly_score": null, "is_anomaly": true}]}': False,
}


@pytest.mark.parametrize("check, cases", [(payloads.check_forecast_responses, FORECAST), (payloads.check_anomaly_responses, ANOMALY)])
def test_response_checks(spark, check, cases):
    frame = spark.createDataFrame([(body,) for body in cases], "body string")
    out = check(frame, "body").collect()
    assert {r.body: r.valid for r in out} == cases
    assert all((r.error is None) == r.valid for r in out)


def test_request_parsing(spark):
    bodies = {"w": '{"instances": [{"a": 1, "b": 2.5}, {"a": 2}]}', "l": '[{"a": 3}]', "o": '{"rows": []}', "t": "text", "n": '{"instances": 4}', "e": "[]"}
    frame = spark.createDataFrame(list(bodies.items()), "id string, body string").withColumn("kind", F.when(F.col("id") == "l", "text/csv").otherwise("application/json"))
    rows, rejected = payloads.parse_requests(frame, "body", "a:int,b:double")
    assert sorted((r.id, r.instance_no, r.a, r.b) for r in rows.collect() if r.id == "w") == [("w", 0, 1, 2.5), ("w", 1, 2, None)]
    assert [r.a for r in rows.where("id = 'l'").collect()] == [3]
    assert {r.id for r in rejected.collect()} == {"o", "t", "n"}
    _, refused = payloads.parse_requests(frame, "body", "a:int", content_type="kind")
    assert {r.id: r.error for r in refused.collect()}["l"] == "unsupported content type"


def test_predictions_json(spark):
    frame = spark.createDataFrame([("r", 1, 2.5), ("r", 0, 1.0), ("q", 0, None)], "id string, n int, p double")
    out = {r.id: json.loads(r.response) for r in payloads.predictions_json(frame, ["id"], "n", F.col("p")).collect()}
    assert out == {"r": {"predictions": [1.0, 2.5]}, "q": {"predictions": [None]}}


SETTINGS = {"energy": {"base_url": "https://data.elexon.co.uk", "path": "/p"}, "weather": {"base_url": "https://api.open-meteo.com", "path": "/q", "timezone": "GMT"}}


def manifests(spark, *requests):
    frame = spark.createDataFrame(requests, "request_id string, event_time_utc string, trigger string, energy_payload string, weather_payload string")
    return ingestion.manifests(frame, prefix="bronze/raw", deployment="d", environment="dev", settings=SETTINGS)


def test_manifests(spark, tmp_path):
    hours = json.dumps({"hourly": {"time": ["2026-03-24T00:00", "2026-03-24T01:00", "2026-03-24T02:00"]}})
    out = manifests(
        spark, ("request-123", "2026-03-24T22:30:00+00:00", "t", '{"data": [{"demand": 1}, {"demand": 2}]}', hours),
        ("none", "2026-03-24T23:00:00+00:00", "t", '{"other": 1}', '{"hourly": {"time": []}}'), ("bad", "2026-03-24T23:30:00+00:00", "t", "502", hours),
        ("lost", "2026-03-25T00:40:00+00:00", "t", '{"data": []}', None),
    )
    rows = {r.request_id: r for r in out.collect()}
    ok = rows["request-123"]
    assert ok.status == "success" and ok.error is None and ok.event.trigger == "t" and ok.sources.weather.timezone == "GMT"
    assert ok.outputs.energy.asDict() == {"source_name": "energy", "s3_key": "bronze/raw/energy/dt=2026-03-24/request-123.json", "record_count": 2}
    assert ok.outputs.weather.asDict() == {
        "source_name": "weather", "s3_key": "bronze/raw/weather/dt=2026-03-24/request-123.json", "hourly_timestamp_count": 3,
        "forecast_start_time": "2026-03-24T00:00", "forecast_end_time": "2026-03-24T02:00"}
    empty = rows["none"].outputs
    assert empty.energy.record_count is None and empty.weather.hourly_timestamp_count == 0 and empty.weather.forecast_start_time is None
    assert rows["bad"].status == "failed" and rows["bad"].outputs is None and "energy" in rows["bad"].error.message
    assert rows["lost"].status == "failed" and "weather" in rows["lost"].error.message
    out.write.json(str(tmp_path / "manifest"))
    assert readers.read_manifests(spark, str(tmp_path / "manifest")).where("outputs.energy.record_count = 2").count() == 1
    health = {(r.dt, r.status): (r.requests, r.records) for r in ingestion.daily_health(out).collect()}
    assert health == {("2026-03-24", "success"): (2, 2), ("2026-03-24", "failed"): (1, 0), ("2026-03-25", "failed"): (1, 0)}


@pytest.mark.parametrize("row_bound", [10, 10**9])
def test_landing_gaps(spark, row_bound):
    times = ["2026-03-24T22:30:00Z", "2026-03-24T23:00:00Z", "2026-03-25T00:45:00Z", "2026-03-25T01:15:00Z"]
    out = manifests(spark, *[(f"r{i}", t, "t", "{}", "{}") for i, t in enumerate(times)])
    gaps = ingestion.landing_gaps(out, 30, row_bound=row_bound).collect()
    assert [(r.request_id, r.gap_minutes, r.missed_landings) for r in gaps] == [("r2", 105.0, 2)]


def test_landing_files(spark, tmp_path):
    payload = spark.createDataFrame([("energy", "r 1", "2026-03-24T22:30:00Z", '{"data": []}')], "source string, request_id string, event_time_utc string, payload string")
    landed = ingestion.landing_rows(payload, "bronze/raw")
    assert landed.first().s3_key == "bronze/raw/energy/dt=2026-03-24/r+1.json"
    writers.write_landing(landed, str(tmp_path / "raw"))
    files = list((tmp_path / "raw").glob("source=energy/dt=2026-03-24/*.txt"))
    assert [f.read_text().strip() for f in files] == ['{"data": []}']
    assert readers.read_requests(spark, str(tmp_path / "raw")).first().value.strip() == '{"data": []}'


def test_model_metadata(spark, tmp_path):
    scoring.save_metadata(spark, str(tmp_path / "m"), {"features": ["a", "b"], "threshold": 0.5, "direction": "<"})
    assert scoring.load_metadata(spark, str(tmp_path / "m"))["features"] == ["a", "b"]
