"""Every registered cost query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from costmart.plans import registry
from costmart.testing.compare import compare, duckdb_connection

SF_SMALL = "/root/testdata/sf0.001"

NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    missing = set(registry.QUERIES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
        return
    r = compare(df, con, sql)
    assert r["ok"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "tag_dim_id" in df.columns
