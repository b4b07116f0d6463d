"""Every registered query with SQL against DuckDB on the same parquet files."""

import os

import pytest

from workload.check import compare, oracle
from workload.registry import registered

ORACLE_DIR = os.environ.get("TEST_ORACLE_DIR", "/root/testdata/sf0.001")
QUERIES = registered()


@pytest.fixture(scope="module")
def con():
    return oracle(ORACLE_DIR)


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_matches_duckdb(spark, con, name):
    run, sql = QUERIES[name]
    assert compare(run(spark, ORACLE_DIR), con, sql) is None


@pytest.mark.parametrize("name", ["ml_candidates", "ml_scores"])
def test_model_queries_give_rows(spark, name):
    assert QUERIES[name][0](spark, ORACLE_DIR).count() > 0


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) >= 90
