"""Every registered query equals its DuckDB statement at sf0.01 (rows-only
check for queries without SQL)."""

import pytest

import __spark_entry__ as ent
from rosterflow.plans.catalog import oracle_queries, spark_queries
from tests.conftest import SF
from tests.oracle_compare import compare, duck

QUERIES = spark_queries()
SQL = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF, key, QUERIES[key], SQL.get(key), con)
    assert r["match"] is not False, r


def test_every_query_has_oracle():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(ent.queries()) and set(SQL) <= set(ent.oracle_sql())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() >= 0
    assert "checkouts" in df.columns
