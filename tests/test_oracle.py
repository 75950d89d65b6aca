"""Every registered query against its SQL in DuckDB, over the whole tables."""

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as contract
from siltstone import catalog

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


def test_entry(spark):
    df = contract.entry(spark)
    assert "pickup_date" not in df.columns and df.count() > 0
