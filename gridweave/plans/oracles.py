"""Independent SQL for the registered queries, over the same tables."""

from __future__ import annotations

import re

from gridweave import schemas

# Common table expressions, prepended where a statement names them.
PARTS = {
    "e": """SELECT event_id, event_type, user_id, ts, value, time_bucket(INTERVAL '30 minutes', ts) AS b,
            CAST(round(value * 100) AS BIGINT) AS c FROM events""",
    "rec": """SELECT *, 'bronze/raw/energy/dt=' || strftime(ts, '%Y-%m-%d') || '/req-' || CAST(event_id // 500 AS VARCHAR) || '.json' AS path,
            CAST(date_part('hour', b) * 2 + date_part('minute', b) // 30 + 1 AS INTEGER) AS sp FROM e""",
    "silver": """SELECT event_type AS dataset_name, sp AS settlement_period, CAST(c AS INTEGER) AS demand_mw, path AS source_object_path,
            strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS publish_time_utc, strftime(b, '%Y-%m-%d %H:%M:%S') AS interval_start_utc,
            strftime(b + INTERVAL '30 minutes', '%Y-%m-%d %H:%M:%S') AS interval_end_utc, strftime(b, '%Y-%m-%d') AS settlement_date,
            strftime(ts, '%Y-%m-%d') AS bronze_ingestion_date FROM rec""",
    "w": """SELECT event_type, date_trunc('hour', b) AS h, CAST(sum(c) // count(*) AS DOUBLE) / 100 AS temperature_2m,
            CAST(count(*) % 101 AS INTEGER) AS relative_humidity_2m, max(value) AS wind_speed_10m FROM e GROUP BY 1, 2""",
    "wlast": """SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY h ORDER BY event_type DESC) = 1""",
    "weather": """SELECT 51.5::DOUBLE AS latitude, -0.125::DOUBLE AS longitude, 'GMT' AS timezone, 'GMT' AS timezone_abbreviation,
            16.0::DOUBLE AS elevation, round(temperature_2m, 6) AS temperature_2m, relative_humidity_2m, round(wind_speed_10m, 6) AS wind_speed_10m,
            'bronze/raw/weather/dt=' || strftime(h, '%Y-%m-%d') || '/' || event_type || '.json' AS source_object_path,
            strftime(h, '%Y-%m-%d %H:%M:%S') AS forecast_time_local, strftime(h, '%Y-%m-%d') AS forecast_date,
            strftime(h, '%Y-%m-%d') AS bronze_ingestion_date, h FROM w""",
    "d": """SELECT event_type AS dataset_name, b AS t, CAST(date_part('hour', b) * 2 + date_part('minute', b) // 30 + 1 AS INTEGER) AS sp,
            CAST(sum(c) // count(*) AS INTEGER) AS y, max(ts) AS pub,
            CAST(dayofweek(b) + 1 AS INTEGER) AS dow, CAST(dayofweek(b) IN (0, 6) AS INTEGER) AS we FROM e GROUP BY 1, 2""",
    "n": """SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY dataset_name) AS n FROM d""",
    "f": """SELECT *, lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2, lag(y, 48) OVER w AS lag_48, avg(y) OVER r AS mean_48,
            min(y) OVER r AS min_48, max(y) OVER r AS max_48, stddev_pop(y) OVER r AS sd_48 FROM d
            WINDOW w AS (PARTITION BY dataset_name ORDER BY t), r AS (PARTITION BY dataset_name ORDER BY t ROWS BETWEEN 47 PRECEDING AND CURRENT ROW)""",
    "gold": """SELECT f.*, wlast.h AS weather_timestamp, temperature_2m, relative_humidity_2m, wind_speed_10m
            FROM f LEFT JOIN wlast ON wlast.h = date_trunc('hour', f.t)""",
    "naive": "SELECT *, lag_48 AS p FROM f WHERE lag_48 IS NOT NULL",
    "res": """SELECT *, abs(y - p) / CASE WHEN sd_48 > 0 THEN sd_48 ELSE (SELECT greatest(stddev_pop(y), 1.0) FROM naive) END AS s FROM naive""",
    "fm": """SELECT dataset_name, avg(abs(y - p)) AS mae, sqrt(avg(pow(y - p, 2))) AS rmse, count(*) AS n,
            1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)) AS r2 FROM naive GROUP BY 1""",
    "cut": "SELECT dataset_name, quantile_cont(s, 0.95) AS q FROM res GROUP BY 1",
    "am": """SELECT dataset_name, max(q) AS q, avg(s) AS m, stddev_pop(s) AS sd, count(*) AS n, count(*) FILTER (WHERE s > q) AS k
            FROM res JOIN cut USING (dataset_name) GROUP BY 1""",
    "chk": """SELECT dataset_name || '-f' AS run_id, 'forecast' AS model_family, u.o AS check_order, u.name, u.v AS observed, u.cmp AS comparator, u.target
            FROM fm, LATERAL (VALUES (1, 'min_training_rows', n::DOUBLE, '>=', 48.0::DOUBLE), (2, 'max_mae', mae, '<=', 5000.0::DOUBLE),
              (3, 'max_rmse', rmse, '<=', 7000.0::DOUBLE), (4, 'min_r2', r2, '>=', 0.0::DOUBLE)) AS u(o, name, v, cmp, target)
            UNION ALL
            SELECT dataset_name || '-a', 'anomaly', u.o, u.name, u.v, u.cmp, u.target
            FROM am, LATERAL (VALUES (1, 'min_training_rows', n::DOUBLE, '>=', 48.0::DOUBLE), (2, 'min_anomaly_rate', round(k / n::DOUBLE, 6), '>=', 0.01::DOUBLE),
              (3, 'max_anomaly_rate', round(k / n::DOUBLE, 6), '<=', 0.2::DOUBLE)) AS u(o, name, v, cmp, target)""",
    "checked": "SELECT *, CASE WHEN comparator = '>=' THEN observed >= target ELSE observed <= target END AS passed FROM chk",
    "body": """SELECT event_id, CASE
              WHEN event_type = 'view' THEN '{"predictions": [' || c || ']}'
              WHEN event_type = 'click' AND event_id % 3 = 0 THEN '{"predictions": [{"mean": [' || c || ', "x"]}]}'
              WHEN event_type = 'click' THEN '{"predictions": [{"mean": [' || c || ']}]}'
              WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN '{"predictions": [{"anomaly_score": ' || c || ', "is_anomaly": 1}]}'
              WHEN event_type = 'purchase' THEN '{"predictions": [{"anomaly_score": ' || c || ', "is_anomaly": true}]}'
              WHEN event_type = 'signup' AND event_id % 3 = 0 THEN '{"predictions": []}'
              WHEN event_type = 'signup' THEN '{"predictions": ["high"]}'
              ELSE '{"predictions": [' || c END AS body FROM e""",
    "req": """SELECT 'user ' || user_id || '/' || strftime(ts, '%Y-%m-%d') AS request_id, user_id, strftime(max(ts), '%Y-%m-%d') AS dt,
            max(ts) AS landed, count(*) AS n, count(DISTINCT date_trunc('hour', ts)) AS hours,
            strftime(min(date_trunc('hour', ts)), '%Y-%m-%dT%H:%M') AS first_hour, strftime(max(date_trunc('hour', ts)), '%Y-%m-%dT%H:%M') AS last_hour,
            user_id % 7 = 0 AS bad FROM events GROUP BY user_id, strftime(ts, '%Y-%m-%d')""",
    "store": """SELECT *, dataset_name || '|' || strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS id FROM f""",
}

T = "strftime(t, '%Y-%m-%d %H:%M:%S') AS interval_start_utc"
WEATHER = """strftime(weather_timestamp, '%Y-%m-%d %H:%M:%S') AS weather_timestamp, round(temperature_2m, 6) AS temperature_2m,
    relative_humidity_2m, round(wind_speed_10m, 6) AS wind_speed_10m"""
ROLLING = """round(mean_48, 6) AS rolling_mean_48_demand_mw, round(min_48::DOUBLE, 6) AS rolling_min_48_demand_mw,
    round(max_48::DOUBLE, 6) AS rolling_max_48_demand_mw"""

ISO = "'%Y-%m-%dT%H:%M:%SZ'"
FEATURES = f"""dataset_name || '|' || strftime(t, {ISO}) AS feature_record_id, dataset_name, strftime(pub, {ISO}) AS publish_time_utc, strftime(t, {ISO}) AS interval_start_utc,
    strftime(t + INTERVAL '30 minutes', {ISO}) AS interval_end_utc, sp::BIGINT AS settlement_period, strftime(t, '%Y-%m-%d') AS settlement_date, y::DOUBLE AS demand_mw,
    strftime(t, '%Y-%m-%d') AS bronze_ingestion_date, coalesce(strftime(weather_timestamp, {ISO}), '') AS weather_timestamp, round(temperature_2m, 6) AS temperature_2m,
    relative_humidity_2m::DOUBLE AS relative_humidity_2m, round(wind_speed_10m, 6) AS wind_speed_10m, CASE WHEN weather_timestamp IS NOT NULL THEN 51.5::DOUBLE END AS latitude,
    CASE WHEN weather_timestamp IS NOT NULL THEN -0.125::DOUBLE END AS longitude, CASE WHEN weather_timestamp IS NOT NULL THEN 'GMT' ELSE '' END AS timezone,
    date_part('hour', t)::BIGINT AS interval_hour, dow::BIGINT AS day_of_week, month(t)::BIGINT AS month_of_year, we::BIGINT AS is_weekend,
    lag_1::DOUBLE AS lag_1_demand_mw, lag_2::DOUBLE AS lag_2_demand_mw, lag_48::DOUBLE AS lag_48_demand_mw, round(mean_48, 6) AS rolling_mean_48_demand_mw,
    min_48::DOUBLE AS rolling_min_48_demand_mw, max_48::DOUBLE AS rolling_max_48_demand_mw"""

RATIOS = """, sd_48 AS rolling_stddev_48_demand_mw, y - mean_48 AS demand_minus_rolling_mean_mw, CASE WHEN mean_48 <> 0 THEN y / mean_48 END AS demand_to_rolling_mean_ratio,
    CASE WHEN sd_48 <> 0 THEN (y - mean_48) / sd_48 END AS rolling_z_score"""
STORED = {"String": "string", "Integral": "bigint", "Fractional": "double"}
NUMERIC = {
    "settlement_period": "sp", "temperature_2m": "temperature_2m", "relative_humidity_2m": "relative_humidity_2m", "wind_speed_10m": "wind_speed_10m",
    "latitude": "CASE WHEN weather_timestamp IS NOT NULL THEN 51.5 END", "longitude": "CASE WHEN weather_timestamp IS NOT NULL THEN -0.125 END",
    "interval_hour": "date_part('hour', t)", "day_of_week": "dow", "month_of_year": "month(t)", "is_weekend": "we", "lag_1_demand_mw": "lag_1", "lag_2_demand_mw": "lag_2",
    "lag_48_demand_mw": "lag_48", "rolling_mean_48_demand_mw": "mean_48", "rolling_min_48_demand_mw": "min_48", "rolling_max_48_demand_mw": "max_48",
}

STATEMENTS = {
    "silver_energy_flatten": "SELECT * FROM silver",
    "silver_weather_flatten": "SELECT * EXCLUDE (h) FROM weather",
    "silver_dedup_latest": """SELECT * FROM silver QUALIFY row_number() OVER (PARTITION BY dataset_name, interval_start_utc, settlement_period
        ORDER BY publish_time_utc DESC, source_object_path DESC, demand_mw DESC) = 1""",
    "silver_weather_latest": """SELECT * EXCLUDE (h) FROM weather QUALIFY row_number() OVER (PARTITION BY h
        ORDER BY bronze_ingestion_date DESC, source_object_path DESC) = 1""",
    "landing_roundtrip": "SELECT * EXCLUDE (source_object_path) FROM silver",
    "landing_by_request": "SELECT * FROM silver",
    "landed_requests": """SELECT event_type || '/' || h || '+0&é' AS request_id, 'sums' AS source,
        'raw/sums/dt=' || substr(h, 1, 10) || '/' || event_type || '%2F' || replace(replace(h, ' ', '+'), ':', '%3A') || '%2B0%26%C3%A9.json' AS source_object_path, total, n
        FROM (SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS h, CAST(sum(c) AS BIGINT) AS total, count(*) AS n FROM e GROUP BY 1, 2)""",
    "silver_table_roundtrip": """SELECT * FROM silver WHERE settlement_date = (SELECT max(settlement_date) FROM silver)
        QUALIFY row_number() OVER (PARTITION BY dataset_name, interval_start_utc, settlement_period
        ORDER BY publish_time_utc DESC, source_object_path DESC, demand_mw DESC) = 1""",
    "gold_join_fanout": f"""SELECT dataset_name, {T}, y AS demand_mw, strftime(h, '%Y-%m-%d %H:%M:%S') AS weather_timestamp,
        round(temperature_2m, 6) AS temperature_2m, relative_humidity_2m, round(wind_speed_10m, 6) AS wind_speed_10m
        FROM d LEFT JOIN w ON w.h = date_trunc('hour', d.t)""",
    "gold_join_balanced": f"""SELECT dataset_name, {T}, y AS demand_mw, round(temperature_2m, 6) AS temperature_2m,
        'bronze/raw/weather/dt=' || strftime(h, '%Y-%m-%d') || '/' || event_type || '.json' AS source_object_path
        FROM d LEFT JOIN w ON w.h = date_trunc('hour', d.t)""",
    "gold_join_latest": f"SELECT dataset_name, {T}, y AS demand_mw, {WEATHER} FROM gold",
    "gold_calendar": """SELECT o_orderkey, CAST(date_part('hour', o_orderdate) AS INTEGER) AS interval_hour,
        CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week, CAST(month(o_orderdate) AS INTEGER) AS month_of_year,
        CAST(dayofweek(o_orderdate) IN (0, 6) AS INTEGER) AS is_weekend FROM orders""",
    "gold_lags": f"""SELECT dataset_name, {T}, y AS demand_mw, lag_1 AS lag_1_demand_mw, lag_2 AS lag_2_demand_mw, lag_48 AS lag_48_demand_mw FROM f""",
    "gold_rolling": f"SELECT dataset_name, {T}, y AS demand_mw, {ROLLING}, round(sd_48, 6) AS rolling_stddev_48_demand_mw FROM f",
    "gold_rolling_past_only": f"""SELECT dataset_name, {T}, round(avg(y) OVER r, 6) AS rolling_mean_48_demand_mw,
        round((min(y) OVER r)::DOUBLE, 6) AS rolling_min_48_demand_mw, round((max(y) OVER r)::DOUBLE, 6) AS rolling_max_48_demand_mw
        FROM d WINDOW r AS (PARTITION BY dataset_name ORDER BY t ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING)""",
    "gold_forecast_features": f"""SELECT dataset_name, {T}, sp AS settlement_period, strftime(t, '%Y-%m-%d') AS settlement_date, y AS demand_mw, {WEATHER},
        CAST(date_part('hour', t) AS INTEGER) AS interval_hour, dow AS day_of_week, CAST(month(t) AS INTEGER) AS month_of_year, we AS is_weekend,
        lag_1 AS lag_1_demand_mw, lag_2 AS lag_2_demand_mw, lag_48 AS lag_48_demand_mw, round(mean_48, 6) AS rolling_mean_48_demand_mw,
        min_48 AS rolling_min_48_demand_mw, max_48 AS rolling_max_48_demand_mw FROM gold""",
    "bronze_files_silver": "SELECT * EXCLUDE (source_object_path) FROM silver",
    "weather_table_roundtrip": "SELECT * EXCLUDE (h) FROM weather",
    "gold_promoted_scan": f"""SELECT dataset_name, {T}, y AS demand_mw, CASE WHEN date_part('hour', t) >= 12 THEN we END AS is_weekend, lag_1 AS lag_1_demand_mw
        FROM (SELECT dataset_name, t, we, sp, y, lag_1 FROM gold) WHERE sp <> 7""",
    "gold_tables_roundtrip": f"""SELECT dataset_name, {T}, lag_2 AS lag_2_demand_mw,
        round(CASE WHEN sd_48 <> 0 THEN (y - mean_48) / sd_48 END, 6) AS rolling_z_score FROM gold""",
    "gold_two_sites": f"""SELECT dataset_name, {T}, y AS demand_mw, round(temperature_2m + u.plus, 6) AS temperature_2m, lag_1 AS lag_1_demand_mw,
        lag_48 AS lag_48_demand_mw, round(mean_48, 6) AS rolling_mean_48_demand_mw
        FROM gold, LATERAL (VALUES (0), (1)) AS u(plus) WHERE u.plus = 0 OR weather_timestamp IS NOT NULL""",
    "gold_anomaly_features": f"""SELECT dataset_name, {T}, y AS demand_mw, we AS is_weekend, round(temperature_2m, 6) AS temperature_2m,
        lag_48 AS lag_48_demand_mw, round(mean_48, 6) AS rolling_mean_48_demand_mw, round(sd_48, 6) AS rolling_stddev_48_demand_mw,
        round(y - mean_48, 6) AS demand_minus_rolling_mean_mw, round(CASE WHEN mean_48 <> 0 THEN y / mean_48 END, 6) AS demand_to_rolling_mean_ratio,
        round(CASE WHEN sd_48 <> 0 THEN (y - mean_48) / sd_48 END, 6) AS rolling_z_score FROM gold""",
    "rolling_chunked": """SELECT event_id, round(lag(value, 1) OVER w, 8) AS lag_1_value, round(lag(value, 2) OVER w, 8) AS lag_2_value,
        round(lag(value, 48) OVER w, 8) AS lag_48_value, round(avg(value) OVER r, 8) AS rolling_mean_48_value,
        round(min(value) OVER r, 8) AS rolling_min_48_value, round(max(value) OVER r, 8) AS rolling_max_48_value,
        round(stddev_pop(value) OVER r, 8) AS rolling_stddev_48_value FROM events
        WINDOW w AS (ORDER BY ts, event_id), r AS (ORDER BY ts, event_id ROWS BETWEEN 47 PRECEDING AND CURRENT ROW)""",
    "rolling_time_range": f"""SELECT dataset_name, {T}, round(avg(y) OVER r, 6) AS mean_24h, min(y) OVER r AS min_24h, max(y) OVER r AS max_24h,
        count(y) OVER r AS rows_24h FROM d
        WINDOW r AS (PARTITION BY dataset_name ORDER BY t RANGE BETWEEN INTERVAL '84600 seconds' PRECEDING AND CURRENT ROW)""",
    "price_frames": """WITH p AS (SELECT CAST(l_shipdate AS TIMESTAMP) AS t, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem),
        dd AS (SELECT t, sum(cents) AS s, count(*) AS k, min(cents) AS lo, max(cents) AS hi FROM p GROUP BY 1),
        fr AS (SELECT t, sum(s) OVER r AS s, sum(k) OVER r AS k, min(lo) OVER r AS lo, max(hi) OVER r AS hi FROM dd WINDOW r AS (ORDER BY t RANGE BETWEEN INTERVAL '14 days' PRECEDING AND CURRENT ROW))
        SELECT strftime(t, '%Y-%m-%d') AS l_shipdate, max(s)::BIGINT AS cents_sum, max(k)::BIGINT AS cents_count, min(lo) AS cents_min, max(hi) AS cents_max, min(s)::BIGINT AS least_sum FROM fr GROUP BY 1""",
    "quantile_sketches": """SELECT l_returnflag, u.share, count(*) AS rows, true AS close FROM lineitem, (VALUES (0.01::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE), (0.99::DOUBLE)) AS u(share) GROUP BY 1, 2""",
    "forecaster_checks": """SELECT k AS training_rows, n - k AS test_rows, true AS loaded_is_equal, true AS metrics_hold, true AS better_than_mean, true AS flags_hold
        FROM (SELECT count(*) AS n, CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS k FROM gold)""",
    "scorer_checks": """SELECT u.model, count(*) AS rows, true AS flags_hold, true AS metrics_hold, true AS few_flagged FROM gold, (VALUES ('isolation'), ('boundary'), ('reconstruction')) AS u(model) GROUP BY 1""",
    "reports_roundtrip": """SELECT run_id, left(run_id, length(run_id) - 2) AS model_group, model_family, 3::BIGINT AS version, bool_and(passed) AS passed,
        CASE WHEN bool_and(passed) THEN 'approve' ELSE 'manual_review' END AS recommendation, count(*) AS checks, arg_min(target, check_order) AS first_target FROM checked GROUP BY 1, 2, 3""",
    "weather_files_silver": "SELECT * EXCLUDE (h) FROM weather",
    "numeric_selection": f"""SELECT u.place, u.feature, u.known, round(u.total, 2) AS total FROM (SELECT {', '.join(f'count({c}) AS n{k}, sum({c}::DOUBLE) AS s{k}' for k, c in enumerate(NUMERIC.values()))} FROM gold),
        LATERAL (VALUES {', '.join(f"({k}, '{n}', n{k}, s{k})" for k, n in enumerate(NUMERIC))}) AS u(place, feature, known, total)""",
    "text_coercion": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN c::DOUBLE WHEN 5 THEN TRY_CAST('-' || c || '.5' AS DOUBLE) ELSE 0 END AS value FROM e""",
    "paired_predictions": f"SELECT dataset_name, {T}, y::DOUBLE AS actual, p::DOUBLE AS predicted FROM naive",
    "training_errors": """SELECT u.*, (SELECT count(*) FROM gold) AS rows FROM (VALUES ('no column', 'KeyError', 'table lacks required columns: absent'), ('no target', 'KeyError', 'table lacks required columns: demand_mw'),
        ('no rows', 'ValueError', 'at least one row is required for training'), ('no numbers', 'ValueError', 'no numeric feature columns are available'),
        ('too few rows', 'ValueError', 'at least three rows are required for residual scoring')) AS u("case", error, message)""",
    "feature_group_schemas": " UNION ALL ".join(f"""SELECT '{group}' AS feature_group, u.feature, u.kind, u.type, true AS fits, u.known FROM (SELECT {', '.join(f'count({n}) AS "n_{n}"' for n in names)}
        FROM (SELECT {source} FROM gold)), LATERAL (VALUES {', '.join(f"('{n}', '{kind}', '{STORED[kind]}', " + f'"n_{n}")' for n, kind in names.items())}) AS u(feature, kind, type, known)"""
        for group, names, source in (("forecast", {"feature_record_id": "String", **schemas.FORECAST_FEATURES}, FEATURES), ("anomaly", {"feature_record_id": "String", **schemas.ANOMALY_FEATURES}, FEATURES + RATIOS))),
    "sequence_parts": """SELECT dataset_name AS series_id, 'kept' AS part, greatest(max(n) - 143, 0) AS rows, string_agg(CAST(y AS VARCHAR), ',' ORDER BY i) FILTER (WHERE i < n - 48) AS encoder,
        string_agg(CAST(y AS VARCHAR), ',' ORDER BY i) FILTER (WHERE i >= n - 48) AS decoder FROM n WHERE i >= n - 96 AND n >= 97 GROUP BY 1
        UNION ALL SELECT dataset_name || '-short', 'rejected', count(*), NULL, NULL FROM n WHERE i < 50 GROUP BY 1
        UNION ALL SELECT dataset_name, 'rejected', count(*), NULL, NULL FROM n WHERE n < 97 GROUP BY 1""",
    "trained_scorer_checks": """SELECT u.model, count(*) AS rows, true AS near_share, true AS no_worse FROM gold, (VALUES ('boundary'), ('encoder')) AS u(model) GROUP BY 1""",
    "source_outages": """WITH l AS (SELECT 'elexon-bmrs' AS source, request_id, landed FROM req WHERE NOT bad UNION ALL SELECT 'open-meteo', request_id, landed FROM req WHERE NOT bad AND hours > 1),
        g AS (SELECT *, lag(landed) OVER o AS since, row_number() OVER o - 1 AS spot, (epoch_us(landed) - epoch_us(lag(landed) OVER o)) / 60000000.0::DOUBLE AS minutes FROM l WINDOW o AS (PARTITION BY source ORDER BY landed, request_id)),
        z AS (SELECT *, spot - coalesce(lag(spot) OVER (PARTITION BY source ORDER BY spot), 0) AS landings_before FROM g WHERE minutes > 30)
        SELECT source, strftime(since, '%Y-%m-%d %H:%M:%S') AS out_since, strftime(landed, '%Y-%m-%d %H:%M:%S') AS back_at, request_id AS back_with, round(minutes, 6) AS minutes,
        CAST(floor(minutes / 30) - 1 AS INTEGER) AS missed_landings, landings_before FROM z""",
    "series_row_index": """SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS time_idx,
        count(*) OVER (PARTITION BY o_orderpriority) AS series_rows FROM orders""",
    "chrono_split": f"""SELECT dataset_name, {T}, i AS time_idx,
        CASE WHEN i < CASE WHEN n < 10 THEN n - 1 ELSE greatest(CAST(floor(n * 0.8::DOUBLE) AS BIGINT), 1) END THEN 'train' ELSE 'test' END AS split FROM n""",
    "horizon_split": f"SELECT dataset_name, {T}, i AS time_idx, CASE WHEN i < n - 48 THEN 'train' ELSE 'holdout' END AS split FROM n",
    "encoder_decoder_windows": """SELECT a.dataset_name, a.i AS time_idx,
        string_agg(CAST(x.y AS VARCHAR), ',' ORDER BY x.i) FILTER (WHERE x.i < a.i + 48) AS encoder,
        string_agg(CAST(x.y AS VARCHAR), ',' ORDER BY x.i) FILTER (WHERE x.i >= a.i + 48) AS decoder
        FROM n a JOIN n x ON x.dataset_name = a.dataset_name AND x.i BETWEEN a.i AND a.i + 95 WHERE a.i + 96 <= a.n GROUP BY 1, 2""",
    "minimum_rows_guard": """SELECT o_custkey, count(*) AS row_count, CAST(10 AS INTEGER) AS required_rows FROM orders GROUP BY 1 HAVING count(*) < 10""",
    "latest_n_per_series": f"SELECT dataset_name, {T}, y AS demand_mw FROM n WHERE i >= n - 96",
    "latest_partition_row": f"""SELECT dataset_name, {T}, y AS demand_mw FROM d WHERE CAST(t AS DATE) = (SELECT max(CAST(t AS DATE)) FROM d)
        QUALIFY row_number() OVER (PARTITION BY dataset_name ORDER BY t DESC) = 1""",
    "candidate_ranking": """SELECT dataset_name, run_id, round(e, 6) AS rmse, CAST(row_number() OVER (PARTITION BY dataset_name ORDER BY e, run_id) AS INTEGER) AS candidate_rank
        FROM (SELECT dataset_name, u.run_id, sqrt(avg(pow(y - u.p, 2))) AS e FROM f, LATERAL (VALUES ('lag_1', lag_1), ('lag_2', lag_2), ('lag_48', lag_48)) AS u(run_id, p)
        WHERE lag_48 IS NOT NULL GROUP BY 1, 2)""",
    "series_records": """SELECT dataset_name, 0::BIGINT AS segment, 0::BIGINT AS first_index, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS start, string_agg(CAST(y AS VARCHAR), ',' ORDER BY i) AS target,
        string_agg(CAST(sp AS VARCHAR), ',' ORDER BY i) AS feat_0, string_agg(CAST(we AS VARCHAR), ',' ORDER BY i) AS feat_1
        FROM n WHERE i < n - 48 GROUP BY 1""",
    "series_records_jsonl": """SELECT dataset_name, 0::BIGINT AS segment, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS points, CAST(sum(y) AS BIGINT) AS demand,
        CAST(sum(sp) AS BIGINT) AS periods FROM d GROUP BY 1""",
    "sequence_dataset": """SELECT a.dataset_name AS series_id, a.i AS time_idx,
        string_agg(CAST(x.y AS VARCHAR), ',' ORDER BY x.i) FILTER (WHERE x.i < a.i + 48) AS encoder,
        string_agg(CAST(x.sp AS VARCHAR), ',' ORDER BY x.i) FILTER (WHERE x.i >= a.i + 48) AS periods_ahead,
        round((max(x.y) FILTER (WHERE x.i = a.i + 48) - min(s.m)) / min(s.s), 6) AS first_normalised
        FROM n a JOIN n x ON x.dataset_name = a.dataset_name AND x.i BETWEEN a.i AND a.i + 95
        JOIN (SELECT dataset_name, avg(y) AS m, stddev_pop(y) AS s FROM n WHERE i < n - 48 GROUP BY 1) s ON s.dataset_name = a.dataset_name
        WHERE a.i + 96 <= a.n - 48 AND a.n >= 97 GROUP BY 1, 2""",
    "constant_columns": """SELECT u.c AS column_name, u.k AS is_constant FROM (
        SELECT count(DISTINCT sp) = 1 AS a, count(DISTINCT y) = 1 AS b, count(DISTINCT date_part('hour', t)) = 1 AS c, count(DISTINCT dow) = 1 AS x,
        count(DISTINCT month(t)) = 1 AS m, count(DISTINCT we) = 1 AS v FROM d) s,
        LATERAL (VALUES ('settlement_period', a), ('demand_mw', b), ('interval_hour', c), ('day_of_week', x), ('month_of_year', m), ('is_weekend', v),
        ('empty', true)) AS u(c, k)""",
    "feature_frame": f"""SELECT dataset_name, {T}, sp::DOUBLE AS settlement_period, round(coalesce(temperature_2m, 0), 6) AS temperature_2m,
        coalesce(relative_humidity_2m, 0)::DOUBLE AS relative_humidity_2m, round(coalesce(wind_speed_10m, 0), 6) AS wind_speed_10m,
        date_part('hour', t)::DOUBLE AS interval_hour, dow::DOUBLE AS day_of_week, month(t)::DOUBLE AS month_of_year, we::DOUBLE AS is_weekend,
        coalesce(lag_48, 0)::DOUBLE AS lag_48_demand_mw, 0.0::DOUBLE AS absent_feature FROM gold""",
    "bootstrap_repeat": """SELECT event_type, cents FROM (SELECT *, row_number() OVER (ORDER BY copy, event_type) AS r FROM (
        SELECT event_type, CAST(sum(c) AS BIGINT) AS cents FROM e GROUP BY 1), range(8) AS q(copy)) WHERE r <= 8""",
    "group_normaliser": """SELECT dataset_name AS series_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS interval_start_utc, round(m, 6) AS target_mean,
        round(s, 6) AS target_scale, round((y - m) / s, 6) AS demand_mw_normalised
        FROM d JOIN (SELECT dataset_name, avg(y) AS m, stddev_pop(y) AS s FROM d GROUP BY 1) USING (dataset_name)""",
    "standardised_columns": """SELECT l_orderkey, l_linenumber, round((l_quantity - a) / x, 6) AS l_quantity, round((l_extendedprice - b) / y, 6) AS l_extendedprice,
        round((l_discount - c) / z, 6) AS l_discount FROM lineitem, (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS x, avg(l_extendedprice) AS b,
        stddev_pop(l_extendedprice) AS y, avg(l_discount) AS c, stddev_pop(l_discount) AS z FROM lineitem)""",
    "inference_panel": """SELECT dataset_name AS series_id, i AS time_idx, i >= n - 48 AS is_decoder,
        CASE WHEN sp <> 7 THEN y::DOUBLE WHEN i < n - 48 THEN 0.0 END AS demand_mw, sp::DOUBLE AS settlement_period, 0.0::DOUBLE AS absent FROM n""",
    "naive_forecast_metrics": """SELECT dataset_name, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2, n AS test_rows FROM fm""",
    "residual_scores": f"SELECT dataset_name, {T}, p AS predicted_demand_mw, round(s, 6) AS anomaly_score FROM res",
    "residual_threshold_flags": """SELECT dataset_name, round(q, 6) AS score_threshold, round(m, 6) AS score_mean, round(sd, 6) AS score_std,
        n AS training_rows, k AS detected_anomaly_rows, round(k / n::DOUBLE, 6) AS anomaly_rate FROM am""",
    "exact_quantiles_spread": """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.05), 6) AS q0, round(quantile_cont(l_extendedprice, 0.5), 6) AS q1,
        round(quantile_cont(l_extendedprice, 0.95), 6) AS q2 FROM lineitem GROUP BY 1""",
    "seasonal_profile_forecast": f"""SELECT h.dataset_name, strftime(h.t, '%Y-%m-%d %H:%M:%S') AS interval_start_utc, h.y AS demand_mw, round(m, 6) AS mean,
        round(q0, 6) AS q0, round(q1, 6) AS q1, round(q2, 6) AS q2 FROM n h LEFT JOIN (SELECT dataset_name, sp, we, avg(y) AS m,
        quantile_cont(y::DOUBLE, 0.1) AS q0, quantile_cont(y::DOUBLE, 0.5) AS q1, quantile_cont(y::DOUBLE, 0.9) AS q2 FROM n WHERE i < n - 48 GROUP BY 1, 2, 3) p
        ON p.dataset_name = h.dataset_name AND p.sp = h.sp AND p.we = h.we WHERE h.i >= h.n - 48""",
    "sequence_scores": """WITH p AS (SELECT dataset_name, sp, we, avg(y) AS m, quantile_cont(y::DOUBLE, 0.1) AS q0, quantile_cont(y::DOUBLE, 0.5) AS q1,
        quantile_cont(y::DOUBLE, 0.9) AS q2 FROM n GROUP BY 1, 2, 3), r AS (SELECT n.dataset_name, i - (n.n - 96) AS k, y, m, q0, q1, q2 FROM n
        JOIN p ON p.dataset_name = n.dataset_name AND p.sp = n.sp AND p.we = n.we WHERE i >= n.n - 96),
        v AS (SELECT dataset_name, avg(y - m) AS v FROM r WHERE k < 48 GROUP BY 1)
        SELECT r.dataset_name AS series_id, k AS time_idx, round(m + v, 6) AS mean, round(q0 + v, 6) AS q0, round(q1 + v, 6) AS q1, round(q2 + v, 6) AS q2
        FROM r JOIN v ON v.dataset_name = r.dataset_name WHERE k >= 48""",
    "metrics_documents": "SELECT dataset_name, round(mae, 6) AS mae, round(rmse, 6) AS rmse, n AS test_rows FROM fm",
    "threshold_checks": """SELECT run_id, model_family, check_order, name, round(observed, 6) AS observed, comparator, target, passed FROM checked""",
    "promotion_report": """SELECT run_id, model_family, bool_and(passed) AS passed, CASE WHEN bool_and(passed) THEN 'approve' ELSE 'manual_review' END AS recommendation,
        count(*) AS checks, coalesce(string_agg(name, ',' ORDER BY check_order) FILTER (WHERE NOT passed), '') AS failing,
        'reports/' || model_family || '/model_package_version=1/20240131000000.json' AS report_key FROM checked GROUP BY 1, 2""",
    "registry_approvals": """WITH v AS (SELECT o_custkey AS model_group, o_totalprice > 150000 AS ok, o_orderdate, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate, o_orderkey) AS version FROM orders) SELECT model_group, CAST(max(version) AS INTEGER) AS latest_version,
        CAST(max(version) FILTER (WHERE ok) AS INTEGER) AS approved_version FROM v GROUP BY 1""",
    "feature_records": """SELECT id AS feature_record_id, u.name, u.value FROM store, LATERAL (VALUES ('feature_record_id', id), ('dataset_name', dataset_name),
        ('publish_time_utc', strftime(pub, '%Y-%m-%dT%H:%M:%SZ')), ('interval_start_utc', strftime(t, '%Y-%m-%dT%H:%M:%SZ')),
        ('settlement_period', CAST(sp AS VARCHAR)), ('settlement_date', strftime(t, '%Y-%m-%d')), ('demand_mw', CAST(y AS VARCHAR)),
        ('is_weekend', CAST(we AS VARCHAR)), ('lag_48_demand_mw', coalesce(CAST(lag_48 AS VARCHAR), '0.0')),
        ('demand_to_rolling_mean_ratio', coalesce(CAST(CASE WHEN mean_48 <> 0 THEN y / mean_48 END AS VARCHAR), '0.0'))) AS u(name, value)""",
    "feature_record_ids": """SELECT event_type || '|' || strftime(b, '%Y-%m-%dT%H:%M:%SZ') AS feature_record_id, max(strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS published,
        count(*) AS n FROM e GROUP BY 1""",
    "feature_group_upsert": """SELECT event_type || '|' || strftime(b, '%Y-%m-%dT%H:%M:%SZ') AS feature_record_id, CAST(c AS INTEGER) AS demand_mw FROM rec
        QUALIFY row_number() OVER (PARTITION BY event_type, b ORDER BY ts DESC, path DESC, c DESC) = 1""",
    "feature_group_store": """SELECT dataset_name || '|' || strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS feature_record_id, CAST(sp AS BIGINT) AS settlement_period,
        (y + CASE WHEN sp <= 24 THEN 1 ELSE 0 END)::DOUBLE AS demand_mw FROM d""",
    "backfill_latest": f"SELECT dataset_name, {T}, y AS demand_mw FROM d ORDER BY t DESC, dataset_name DESC LIMIT 1000",
    "feature_value_text": """SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS VARCHAR) AS plain, CAST(l_extendedprice * 4096.0::DOUBLE AS VARCHAR) AS large,
        CAST(l_extendedprice * 1e13::DOUBLE AS VARCHAR) AS huge, CAST(l_extendedprice / 1048576.0::DOUBLE AS VARCHAR) AS small,
        CAST(l_extendedprice * l_discount / 1e12::DOUBLE AS VARCHAR) AS tiny FROM lineitem""",
    "payload_latest_row": """SELECT dataset_name, CAST(sp AS BIGINT) AS settlement_period, CAST(date_part('hour', t) AS BIGINT) AS interval_hour,
        CAST(we AS BIGINT) AS is_weekend, strftime(t, '%Y-%m-%d') AS settlement_date, true AS target_hidden FROM d
        WHERE CAST(t AS DATE) = (SELECT max(CAST(t AS DATE)) FROM d) QUALIFY row_number() OVER (PARTITION BY dataset_name ORDER BY t DESC) = 1""",
    "payload_sequence": """SELECT dataset_name, true AS valid, count(*) AS instances, string_agg(CAST(y AS VARCHAR), ',' ORDER BY i) AS demand,
        string_agg(CAST(sp AS VARCHAR), ',' ORDER BY i) AS periods FROM n WHERE i >= n - 96 GROUP BY 1""",
    "payload_history_future": """SELECT dataset_name, true AS valid, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS start,
        string_agg(CAST(y AS VARCHAR), ',' ORDER BY i) FILTER (WHERE i < n - 48) AS target, string_agg(CAST(sp AS VARCHAR), ',' ORDER BY i) AS feat_0,
        string_agg(CAST(we AS VARCHAR), ',' ORDER BY i) AS feat_1 FROM n WHERE i >= n - 96 GROUP BY 1""",
    "forecast_response_checks": """SELECT event_id, CASE WHEN NOT json_valid(body) THEN false ELSE coalesce(
        json_type(body, '$.predictions[0]') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN') OR (json_type(body, '$.predictions[0]') = 'OBJECT'
        AND json_array_length(body, '$.predictions[0].mean') > 0
        AND len(list_filter(json_extract(body, '$.predictions[0].mean[*]'), lambda x: json_type(x) NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN'))) = 0), false)
        END AS valid FROM body""",
    "anomaly_response_checks": """SELECT event_id, CASE WHEN NOT json_valid(body) THEN false ELSE coalesce(
        json_type(body, '$.predictions[0].anomaly_score') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN')
        AND json_type(body, '$.predictions[0].is_anomaly') = 'BOOLEAN', false) END AS valid FROM body""",
    "request_parsing": """SELECT l_orderkey, CASE WHEN l_orderkey % 4 = 1 THEN 0 ELSE count(*) END AS instances,
        CASE WHEN l_orderkey % 4 <> 1 THEN CAST(sum(l_quantity) AS BIGINT) END AS quantity FROM lineitem GROUP BY 1""",
    "predictions_response": """SELECT l_orderkey, '{"predictions":[' || string_agg(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), ',' ORDER BY l_linenumber, l_quantity) || ']}' AS response
        FROM lineitem GROUP BY 1""",
    "ingestion_manifest": """SELECT request_id, CASE WHEN bad THEN 'failed' ELSE 'success' END AS status,
        CASE WHEN NOT bad THEN 'bronze/raw/energy/dt=' || dt || '/' || replace(replace(request_id, ' ', '+'), '/', '%2F') || '.json' END AS energy_key,
        CASE WHEN NOT bad THEN CAST(n AS INTEGER) END AS record_count, CASE WHEN NOT bad THEN CAST(hours AS INTEGER) END AS hours,
        CASE WHEN NOT bad THEN first_hour END AS first_hour, CASE WHEN NOT bad THEN last_hour END AS last_hour,
        CASE WHEN bad THEN 'energy payload is not a JSON object' END AS error_message FROM req""",
    "ingestion_health": """SELECT dt, CASE WHEN bad THEN 'failed' ELSE 'success' END AS status, count(*) AS requests,
        CAST(sum(CASE WHEN bad THEN 0 ELSE n END) AS BIGINT) AS records FROM req GROUP BY 1, 2""",
    "ingestion_gaps": """SELECT request_id, strftime(landed, '%Y-%m-%d %H:%M:%S') AS landed_at, round(g, 6) AS gap_minutes, CAST(floor(g / 30) - 1 AS INTEGER) AS missed_landings
        FROM (SELECT request_id, landed, (epoch_us(landed) - epoch_us(lag(landed) OVER (ORDER BY landed, request_id))) / 60000000.0::DOUBLE AS g FROM req WHERE NOT bad) WHERE g > 30""",
    "gold_single_series": """WITH x AS (SELECT d.*, w.temperature_2m, w.relative_humidity_2m, w.wind_speed_10m, w.h FROM d LEFT JOIN w ON w.h = date_trunc('hour', d.t)),
        y AS (SELECT t, y, lag(y, 48) OVER o AS l, avg(y) OVER r AS a, min(y) OVER r AS mn, max(y) OVER r AS mx FROM x
        WINDOW o AS (ORDER BY t, sp, pub, h, temperature_2m, relative_humidity_2m, wind_speed_10m),
        r AS (ORDER BY t, sp, pub, h, temperature_2m, relative_humidity_2m, wind_speed_10m ROWS BETWEEN 47 PRECEDING AND CURRENT ROW))
        SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS interval_start_utc, count(*) AS n, CAST(sum(y) AS BIGINT) AS demand, CAST(sum(l) AS BIGINT) AS lag_48,
        round(sum(a), 4) AS rolling_mean, CAST(sum(mn) AS BIGINT) AS rolling_min, CAST(sum(mx) AS BIGINT) AS rolling_max FROM y GROUP BY 1""",
    "stream_halfhour_demand": """SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS interval_start_utc, event_type, CAST(sum(c) AS BIGINT) AS total, count(*) AS n FROM e
        GROUP BY b, event_type""",
    "gold_weather_as_of": f"""WITH wp AS (SELECT w.*, p.pub FROM w JOIN (SELECT event_type, date_trunc('hour', b) AS h, max(ts) - INTERVAL '45 minutes' AS pub FROM e GROUP BY 1, 2) p
        USING (event_type, h)), x AS (SELECT d.dataset_name AS dn, d.t AS dt, wp.* FROM d JOIN wp ON wp.h = date_trunc('hour', d.t) AND wp.pub <= d.t
        QUALIFY row_number() OVER (PARTITION BY d.dataset_name, d.t ORDER BY wp.pub DESC, wp.event_type DESC) = 1)
        SELECT dataset_name, {T}, y AS demand_mw, strftime(x.h, '%Y-%m-%d %H:%M:%S') AS weather_timestamp, round(temperature_2m, 6) AS temperature_2m,
        relative_humidity_2m, round(wind_speed_10m, 6) AS wind_speed_10m FROM d LEFT JOIN x ON x.dn = dataset_name AND x.dt = t""",
    "recurrence_scan": f"""WITH RECURSIVE r AS (SELECT DISTINCT dataset_name, -1::BIGINT AS i, NULL::TIMESTAMP AS t, 0::DOUBLE AS v, list_resize([0::DOUBLE], 48, 0::DOUBLE) AS s FROM n
        UNION ALL SELECT dataset_name, i, t, v, list_append(s[2:], v) FROM (SELECT n.dataset_name, n.i, n.t, n.y / 7919.0::DOUBLE + 0.5::DOUBLE * r.s[48] + 0.25::DOUBLE * r.s[47] + 0.2::DOUBLE * r.s[1] AS v, r.s
          FROM r JOIN n ON n.dataset_name = r.dataset_name AND n.i = r.i + 1))
        SELECT dataset_name, {T}, round(v, 6) AS value FROM r WHERE i >= 0""",
    "seasonal_fit_equations": """SELECT dataset_name AS series_id, u.term, true AS holds FROM (SELECT DISTINCT dataset_name FROM d),
        (VALUES ('constant'), ('lag_1'), ('lag_2'), ('lag_48'), ('settlement_period'), ('is_weekend'), ('echo_1'), ('echo_48')) AS u(term)""",
    "as_of_carried": """SELECT event_id, purchase_id, purchase_cents FROM (SELECT event_id, event_type,
        last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER o AS purchase_id,
        last_value(CASE WHEN event_type = 'purchase' THEN c END IGNORE NULLS) OVER o AS purchase_cents FROM e WHERE event_type IN ('view', 'purchase')
        WINDOW o AS (ORDER BY ts, event_type = 'view', event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) WHERE event_type = 'view'""",
    "stream_silver": "SELECT * FROM silver",
    "stream_relanded_records": "SELECT DISTINCT dataset_name, interval_start_utc, settlement_period, publish_time_utc, settlement_date FROM silver",
    "stream_gold_refresh": """WITH s AS (SELECT *, CAST(interval_start_utc AS TIMESTAMP) AS t FROM silver QUALIFY row_number() OVER (PARTITION BY dataset_name, interval_start_utc,
        settlement_period ORDER BY publish_time_utc DESC, source_object_path DESC, demand_mw DESC) = 1)
        SELECT dataset_name, interval_start_utc, demand_mw, strftime(wlast.h, '%Y-%m-%d %H:%M:%S') AS weather_timestamp, round(temperature_2m, 6) AS temperature_2m,
        lag(demand_mw, 1) OVER w AS lag_1_demand_mw, lag(demand_mw, 48) OVER w AS lag_48_demand_mw, round(avg(demand_mw) OVER r, 6) AS rolling_mean_48_demand_mw
        FROM s LEFT JOIN wlast ON wlast.h = date_trunc('hour', s.t)
        WINDOW w AS (PARTITION BY dataset_name ORDER BY s.t), r AS (PARTITION BY dataset_name ORDER BY s.t ROWS BETWEEN 47 PRECEDING AND CURRENT ROW)""",
    "feature_store_forecast": f"SELECT {FEATURES} FROM gold",
    "feature_store_backfill": f"""SELECT {FEATURES.replace('y::DOUBLE AS demand_mw', '(y + CASE WHEN k <= 1000 THEN 1 ELSE 0 END)::DOUBLE AS demand_mw')},
        round(sd_48, 6) AS rolling_stddev_48_demand_mw, round(y - mean_48, 6) AS demand_minus_rolling_mean_mw,
        round(CASE WHEN mean_48 <> 0 THEN y / mean_48 END, 6) AS demand_to_rolling_mean_ratio, round(CASE WHEN sd_48 <> 0 THEN (y - mean_48) / sd_48 END, 6) AS rolling_z_score
        FROM (SELECT *, row_number() OVER (ORDER BY t DESC, sp DESC, dataset_name DESC) AS k FROM gold)""",
}


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name, body in PARTS.items():
        if name not in seen and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b|,\s*{name}\s+(?:JOIN|LEFT)", sql):
            _needed(body, seen)
            seen.append(name)
    return seen


def statement(sql: str) -> str:
    """The statement with the common table expressions it uses, in dependency order."""
    parts = [f"{name} AS ({PARTS[name]})" for name in _needed(sql, [])]
    if not parts:
        return sql
    for start in ("WITH RECURSIVE ", "WITH "):
        if sql.startswith(start):
            return f"{start}{', '.join(parts)}, {sql.removeprefix(start)}"
    return f"WITH {', '.join(parts)} {sql}"


STATEMENTS["rolling_time_range_dense"] = STATEMENTS["rolling_time_range"]


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in STATEMENTS.items()}
