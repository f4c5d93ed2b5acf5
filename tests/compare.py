"""Run registered queries next to their SQL and report the differences."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(v).__name__, v) for v in (normal(row[i]) for i in order)) for row in rows)


def difference(spark: SparkSession, query, sql: str, folder: str) -> str | None:
    """None if equal, else a short description."""
    frame = query(spark, folder)
    with connection(folder) as db:
        result = db.execute(sql)
        names = [d[0] for d in result.description]
        expected = rows_of(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    actual = rows_of(frame.columns, frame.collect())
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (f"{sum(actual.values())} rows against {sum(expected.values())}; {sum(extra.values())} differ\n"
            f"  spark: {sorted(map(str, extra))[:2]}\n  sql:   {sorted(map(str, missing))[:2]}")


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            if name in oracle:
                outcome = difference(spark, query, oracle[name], folder)
                outcome = "ok" if outcome is None else "DIFF " + outcome
            else:
                outcome = f"rows {len(query(spark, folder).collect())}"
        except Exception as error:  # report and go on with the next query
            outcome = "ERROR " + str(error)[:900]
        print(f"{name:28s} {time.time() - begin:6.2f}s {outcome}", flush=True)
