"""Every registered query beside its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES = spark_entry.queries()
ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    good, text = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert good, text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_twin_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0 and df.columns == ["bucket_ms", "name", "k", "user_id", "value"]
