"""Keyed tables: versions, retries, compaction, and what a failure leaves."""

import pytest

from gridweave.sources.keyed import KeyedTable

SCHEMA = "id string, at int, value string"


def rows(table, spark):
    return sorted(map(tuple, table.read(spark).select("id", "at", "value").collect()), key=repr)


def test_versions_and_retries(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ["id"], ["at"], buckets=4)
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    make = lambda *r: spark.createDataFrame(r, SCHEMA)
    table.write(make(("a", 1, "a1"), ("b", 5, "b5"), ("a", 0, "a0"), (None, 1, "x"), (None, 1, "x")), 0)
    assert rows(table, spark) == [("a", 1, "a1"), ("b", 5, "b5"), (None, 1, "x"), (None, 1, "x")]
    table.write(make(("a", 2, "a2"), ("b", 4, "late"), ("c", None, "c")), 1)
    table.write(make(("a", 2, "a2"), ("b", 4, "late"), ("c", None, "c")), 1)  # a retried run
    expected = [("a", 2, "a2"), ("b", 5, "b5"), ("c", None, "c"), (None, 1, "x"), (None, 1, "x")]
    assert rows(table, spark) == sorted(expected, key=repr)
    table.compact(spark)
    assert rows(table, spark) == sorted(expected, key=repr)
    table.write(make(("a", 9, "too late for its number")), 1)  # the base holds it
    table.compact(spark)
    assert rows(table, spark) == sorted(expected, key=repr)
    table.write(make(("a", 2, "a2 again")), 2)  # equal order: the later batch
    assert ("a", 2, "a2 again") in rows(table, spark) and len(rows(table, spark)) == 5
    table.compact(spark)
    assert ("a", 2, "a2 again") in rows(table, spark) and len(rows(table, spark)) == 5
    versions = {p.name for p in (tmp_path / "t" / "base").iterdir()}
    assert versions == {"version=1", "version=2"}
    assert len(list((tmp_path / "t" / "base" / "version=2").glob("bucket=*"))) == 1  # only what the batch touched


def test_first_version(spark, tmp_path):
    table = KeyedTable(str(tmp_path), ["id", "at"], needs=["id"], first=True, buckets=3)
    for number in range(6):
        table.write(spark.createDataFrame([(f"k{k}", k if k % 2 else None, f"batch {number}") for k in range(number + 1)], SCHEMA), number)
        if number in (2, 4):
            table.compact(spark)
    assert rows(table, spark) == sorted([(f"k{k}", k if k % 2 else None, f"batch {k}") for k in range(6)], key=repr)


def test_an_unfinished_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    table = KeyedTable(str(tmp_path), ["id"], ["at"], buckets=4)
    table.write(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], SCHEMA), 0)
    before = rows(table, spark)
    monkeypatch.setattr(KeyedTable, "_append", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.compact(spark)
    with pytest.raises(ZeroDivisionError):
        table.write(spark.createDataFrame([("a", 2, "z")], SCHEMA), 1)
    assert rows(table, spark) == before
    monkeypatch.undo()
    table.compact(spark)
    assert rows(table, spark) == before
