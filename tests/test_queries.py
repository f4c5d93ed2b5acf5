"""Every query of the library against its SQL, on the smallest tables; tests/llm has those of the text operators."""

import pytest

import __spark_entry__ as entry
from compare import difference
from gridweave.plans import catalog, oracles

FOLDER = "/root/testdata/sf0.001"
ORACLE = oracles.oracle_sql()


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(ORACLE) <= set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert difference(spark, entry.queries()[name], ORACLE[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
