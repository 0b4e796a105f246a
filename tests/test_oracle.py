"""Every catalogue query with oracle SQL equals DuckDB on the smallest tables;
queries without SQL run and return rows."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import compare

QUERIES = E.queries()
ORACLE = E.oracle_sql()
SQL_NAMES = sorted(ORACLE)
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


def test_every_query_has_an_entry():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 100


@pytest.mark.parametrize("name", SQL_NAMES)
def test_matches_duckdb(spark, duck, name):
    res = compare(spark, duck, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res["ok"], res.get("why")


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["site", "month", "days_over", "total_days", "percentage"]
