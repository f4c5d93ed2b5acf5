"""Registered text queries against their SQL, and the set of them."""

import re

import pytest

import __spark_entry__ as entry
from compare import difference
from gridweave.llm import registry

FOLDER = "/root/testdata/sf0.001"


def test_one_query_of_each_number():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, name):
    assert difference(spark, registry.QUERIES[name], registry.ORACLES[name], FOLDER) is None
