"""The driver's contract: entry() on sf0.001 and every SQL-checked query at
sf0.01 against DuckDB (row count, column names, values)."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF001, SF01
from oracle import compare, duck

SQLS = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["crime_type", "outcome_type", "n", "pct"]


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, QUERIES[name], SQLS[name], SF01)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQLS)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF001).count() >= 0
