"""Incremental runs equal batch runs."""

import datetime as dt
import json

from pyspark.sql import functions as F

from gridweave.operators import gold, silver
from gridweave.sources import readers, writers
from gridweave.streaming import incremental


def payload(day, periods, offset=0, published=0):
    records = []
    for p in periods:
        at = dt.datetime(2026, 3, day) + dt.timedelta(minutes=30 * p)
        records.append({
            "dataset": "ITSDO", "publishTime": (at + dt.timedelta(hours=1 + published)).isoformat() + "Z", "startTime": at.isoformat() + "Z",
            "settlementDate": at.date().isoformat(), "settlementPeriod": p + 1, "demand": 1000 + 50 * day + p + offset,
        })
    return {"data": records}


def land(folder, name, document):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(document, indent=2))


def test_new_files_only(spark, tmp_path):
    bronze, target, checkpoint = tmp_path / "bronze", str(tmp_path / "silver"), str(tmp_path / "cp")
    land(bronze / "dt=2026-03-24", "a", payload(24, range(48)))
    incremental.stream_energy_to_silver(spark, str(bronze), target, checkpoint).awaitTermination()
    assert readers.read_table(spark, target).count() == 48
    land(bronze / "dt=2026-03-25", "b", payload(25, range(10)))
    incremental.stream_energy_to_silver(spark, str(bronze), target, checkpoint).awaitTermination()
    rows = readers.read_table(spark, target)
    assert rows.count() == 58 and rows.where("bronze_ingestion_date = '2026-03-25'").count() == 10


def test_weather_stream(spark, tmp_path):
    hourly = {"time": ["2026-03-24T00:00", "2026-03-24T01:00"], "temperature_2m": [1.0, 2.0], "relative_humidity_2m": [3, 4], "wind_speed_10m": [5.0, 6.0]}
    land(tmp_path / "w", "a", {"latitude": 51.5, "longitude": 0.1, "timezone": "GMT", "hourly": hourly})
    incremental.stream_weather_to_silver(spark, str(tmp_path / "w"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.temperature_2m for r in readers.read_table(spark, str(tmp_path / "out")).collect()) == [1.0, 2.0]


def test_relanded_records_are_dropped(spark, tmp_path):
    bronze = tmp_path / "bronze"
    land(bronze, "a", payload(24, range(4)))
    land(bronze, "b", payload(24, range(6)))
    land(bronze, "c", payload(24, range(1), published=5))
    stream = silver.energy_to_silver(incremental.stream_bronze(spark, str(bronze), incremental.schemas.BRONZE_ENERGY))
    query = (
        incremental.drop_relanded(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_a_late_backfill_is_kept(spark, tmp_path):
    """Records published weeks before the newest seen stay, copies collapse, and the stream equals a batch over the files."""
    bronze, target = tmp_path / "bronze", str(tmp_path / "out")
    for name, document in (("a", payload(24, range(4))), ("b", payload(2, range(3))), ("c", payload(24, range(6))), ("d", payload(2, range(4)))):
        land(bronze, name, document)
        stream = silver.energy_to_silver(incremental.stream_bronze(spark, str(bronze), incremental.schemas.BRONZE_ENERGY))
        incremental.stream_relanded(stream, target, str(tmp_path / "cp")).awaitTermination()
    flat = silver.energy_to_silver(readers.read_bronze_energy(spark, str(bronze)))
    expected = flat.select(incremental.RECORD).distinct()
    found = incremental.read_relanded(spark, target)
    show = lambda df: sorted(map(repr, df.select(incremental.RECORD).collect()))
    assert show(found) == show(expected) and found.count() == 10 and sorted(found.columns) == sorted(flat.columns)


def test_gold_refresh_equals_full_run(spark, tmp_path):
    silver_energy, silver_weather, target = (str(tmp_path / n) for n in ("se", "sw", "gold"))
    weather = spark.sql("""SELECT 51.5D AS latitude, 0.1D AS longitude, 'GMT' AS timezone, 'GMT' AS timezone_abbreviation, 1.0D AS elevation, 9.5D AS temperature_2m,
        70 AS relative_humidity_2m, 3.0D AS wind_speed_10m, 'p' AS source_object_path, TIMESTAMP '2026-03-22 05:00:00' AS forecast_time_local,
        DATE '2026-03-22' AS forecast_date, '2026-03-22' AS bronze_ingestion_date""")
    writers.write_weather_silver(weather, silver_weather)

    def add(name, *documents):
        folder = tmp_path / name
        for i, document in enumerate(documents):
            land(folder, str(i), document)
        flat = silver.energy_to_silver(readers.read_bronze_energy(spark, str(folder)))
        flat.write.mode("append").partitionBy("settlement_date").parquet(silver_energy)

    def check():
        incremental.refresh_gold(spark, silver_energy, silver_weather, target, str(tmp_path / "cp")).awaitTermination()
        full = gold.forecast_features(silver.latest_energy(readers.read_table(spark, silver_energy)), weather)
        columns = sorted(full.columns)
        show = lambda df: sorted(map(repr, df.select(columns).collect()))
        assert show(readers.read_table(spark, target)) == show(full)

    # Days of 20 and 48 rows, with a gap, so that 48 rows reach over several dates.
    add("first", payload(20, range(48)), payload(21, range(20)), payload(22, range(20)), payload(24, range(20)), payload(25, range(48)), payload(26, range(48)))
    check()
    add("second", payload(21, range(5), offset=7, published=9))
    check()
    add("third", payload(23, range(3)), payload(27, range(2)))
    check()


def test_gold_refresh_keeps_rows_without_a_date(spark, tmp_path):
    silver_energy, silver_weather, target = (str(tmp_path / n) for n in ("se", "sw", "gold"))
    weather = spark.sql("""SELECT 51.5D AS latitude, 0.1D AS longitude, 'GMT' AS timezone, 'GMT' AS timezone_abbreviation, 1.0D AS elevation, 9.5D AS temperature_2m,
        70 AS relative_humidity_2m, 3.0D AS wind_speed_10m, 'p' AS source_object_path, TIMESTAMP '2026-03-22 05:00:00' AS forecast_time_local,
        DATE '2026-03-22' AS forecast_date, '2026-03-22' AS bronze_ingestion_date""")
    writers.write_weather_silver(weather, silver_weather)
    undated, startless = payload(21, range(3)), payload(21, range(2, 5), published=3)
    for record in undated["data"]:
        record["settlementDate"] = None
    for record in startless["data"]:
        record["startTime"] = None
    later = payload(21, range(1, 3), offset=4, published=9)  # dated versions of undated rows
    documents = (("first", payload(20, range(48))), ("second", undated), ("third", payload(28, range(4))), ("fourth", startless), ("fifth", later), ("sixth", payload(10, range(2))))
    for name, document in documents:
        land(tmp_path / name, name, document)
        flat = silver.energy_to_silver(readers.read_bronze_energy(spark, str(tmp_path / name)))
        flat.write.mode("append").partitionBy("settlement_date").parquet(silver_energy)
        incremental.refresh_gold(spark, silver_energy, silver_weather, target, str(tmp_path / "cp")).awaitTermination()
        full = gold.forecast_features(silver.latest_energy(readers.read_table(spark, silver_energy)), weather)
        show = lambda df: sorted(map(repr, df.select(sorted(full.columns)).collect()))
        assert show(readers.read_table(spark, target)) == show(full)
    assert readers.read_table(spark, target).where("settlement_date IS NULL").count() == 1
    assert readers.read_table(spark, target).where("interval_start_utc IS NULL").count() == 3


def test_gold_refresh_leaves_other_days_alone(spark, tmp_path):
    """Rows without a date do not make all of Gold again."""
    silver_energy, silver_weather, target = (str(tmp_path / n) for n in ("se", "sw", "gold"))
    hour = "TIMESTAMP '2026-03-22 05:00:00'"
    writers.write_weather_silver(spark.sql(f"""SELECT 51.5D AS latitude, 0.1D AS longitude, 'GMT' AS timezone, 'GMT' AS timezone_abbreviation, 1.0D AS elevation, 9.5D AS temperature_2m,
        70 AS relative_humidity_2m, 3.0D AS wind_speed_10m, 'p' AS source_object_path, {hour} AS forecast_time_local, DATE '2026-03-22' AS forecast_date, '2026-03-22' AS bronze_ingestion_date"""), silver_weather)

    def run(name, *documents):
        for i, document in enumerate(documents):
            land(tmp_path / name, str(i), document)
        silver.energy_to_silver(readers.read_bronze_energy(spark, str(tmp_path / name))).write.mode("append").partitionBy("settlement_date").parquet(silver_energy)
        incremental.refresh_gold(spark, silver_energy, silver_weather, target, str(tmp_path / "cp")).awaitTermination()
        return {f.parent.name: f.name for f in (tmp_path / "gold").rglob("*.parquet")}

    undated = payload(20, range(48))
    for record in undated["data"]:
        record["settlementDate"] = None
    before = run("first", *[payload(day, range(48)) for day in range(10, 20)], undated)
    after = run("second", payload(16, range(3), offset=5, published=9))
    changed = {day for day in before if before[day] != after[day]}
    assert changed == {"interval_date=2026-03-16", "interval_date=2026-03-17"} and len(after) == 11


def test_affected_dates(spark):
    days = spark.createDataFrame([("x", d, 20) for d in range(10)], "dataset_name string, interval_date int, n int")
    touched = spark.createDataFrame([(3,)], "d int")
    rewrite, read = incremental.affected_dates(days, touched)
    assert sorted(r.interval_date for r in rewrite.collect()) == [3, 4, 5, 6]
    assert sorted(r.interval_date for r in read.collect()) == [0, 1, 2, 3, 4, 5, 6]


def test_half_hour_windows(spark, tmp_path):
    frame = spark.range(300).select(F.timestamp_seconds(F.lit(1_700_000_400) + F.col("id") * 60).alias("t"), F.lit("k").alias("k"), F.lit(1).alias("v"))
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    query = (
        incremental.half_hour_sums(stream, "t", "k", "v").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() > 5 and out.agg(F.max("total")).first()[0] == 30


def test_day_counts_reach_out_for_sparse_series(spark):
    days = [("dense", d, 0) for d in range(60, 100)] + [("sparse", d, 0) for d in (1, 80)]
    frame = spark.createDataFrame(days, "dataset_name string, day int, settlement_period int").select(
        "dataset_name", F.date_add(F.lit(dt.date(2026, 1, 1)), F.col("day")).alias("interval_date"),
        F.timestamp_seconds(F.col("day") * 86400).alias("interval_start_utc"), "settlement_period")
    touched = spark.createDataFrame([(dt.date(2026, 1, 1) + dt.timedelta(days=80),)], "d date")
    near = incremental.rows_per_day(frame.where("dataset_name = 'dense'"), touched, rows=5)
    assert near.count() == 17
    assert incremental.rows_per_day(frame, touched, rows=5).count() == 42


def test_half_hour_sums_lose_nothing(spark, tmp_path):
    """Files that land out of order, weeks late, give the sums of the whole table, and a second run adds only new files."""
    rows = [(f"2026-03-{day:02d} {hour:02d}:{minute:02d}:00", "ab"[hour % 2], day + hour) for day in (25, 3, 26) for hour in range(0, 24, 5) for minute in (1, 29, 31)]
    frame = spark.createDataFrame(rows, "at string, k string, v int").selectExpr("CAST(at AS timestamp) AS ts", "k", "CAST(v AS bigint) AS v")
    parts = [frame.where(f"day(ts) = {day}") for day in (25, 3, 26)]
    for number, part in enumerate(parts[:2]):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: incremental.stream_half_hour_sums(
        spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), "ts", "k", "v", f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    run()
    parts[2].coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    got = incremental.read_half_hour_sums(spark, f"{tmp_path}/out", "k").selectExpr("CAST(interval_start_utc AS string) AS t", "k", "total", "n")
    expected = frame.groupBy(F.window("ts", "30 minutes").start.cast("string").alias("t"), "k").agg(F.sum("v").alias("total"), F.count("v").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_relanded_batches_are_merged(spark, tmp_path):
    """Compaction changes no row, and a read after it opens the base alone."""
    bronze, target = tmp_path / "bronze", str(tmp_path / "out")
    for number in range(7):
        land(bronze, str(number), payload(24 - 3 * (number % 3), range(4 + number)))
        stream = silver.energy_to_silver(incremental.stream_bronze(spark, str(bronze), incremental.schemas.BRONZE_ENERGY))
        incremental.stream_relanded(stream, target, str(tmp_path / "cp"), compact_every=3).awaitTermination()
    flat = silver.energy_to_silver(readers.read_bronze_energy(spark, str(bronze)))
    found = incremental.read_relanded(spark, target)
    show = lambda df: sorted(map(repr, df.select(incremental.RECORD).collect()))
    assert show(found) == show(flat.select(incremental.RECORD).distinct())
    files = found.inputFiles()
    assert any("/base/" in f for f in files) and {f.split("/batch=")[1].split("/")[0] for f in files if "/batch=" in f} == {"6"}
