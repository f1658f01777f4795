"""Every registered query against its DuckDB formulation (the driver's check)."""

import pytest

import __spark_entry__ as entry_mod
from oracle_check import compare, duck

from conftest import SF_SMALL
from stratum.plans import catalog, oracle

QUERIES = catalog.build()
SQL = oracle.build()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL.get(name), con)
    assert r["status"] in ("match", "rows-only"), r


def test_every_query_has_sql_or_is_documented():
    missing = sorted(set(QUERIES) - set(SQL))
    assert set(QUERIES) <= set(entry_mod.queries()) and set(SQL) <= set(entry_mod.oracle_sql())
    assert missing == sorted(entry_mod.ROWS_ONLY), missing


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert "total_revenue" in df.columns
