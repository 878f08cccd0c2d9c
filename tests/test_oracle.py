"""Differential check: every registered query against its independent SQL (DuckDB)."""

import pytest

import __spark_entry__ as entry
from support import SF_CHECK
from oracle_check import compare, duck
from tarmac.plans.oracle import ORACLE
from tarmac.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(QUERIES[name](spark, SF_CHECK), con, ORACLE[name])
    assert result["columns_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["values_match"], result


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["route", "trip_count"]
    assert df.count() >= 0
