"""Every registered query, against its SQL where there is one."""

import pytest

import __spark_entry__ as spark_entry
from compare import TABLES, assert_same, duckdb_views

QUERIES = spark_entry.queries()
SQL = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_views(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["StationId", "Month", "Year"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, con, name):
    assert assert_same(QUERIES[name](spark, sf_dir), con, SQL[name]) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, small_dir, name):
    assert len(QUERIES[name](spark, small_dir).collect()) > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_python_workers(spark, small_dir, name):
    if "stream" in name or name.startswith("op") or name == "pipeline":
        pytest.skip("runs a stream, or has tests of its own")
    plan = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_tables_exist(sf_dir):
    from pathlib import Path

    assert all((Path(sf_dir) / f"{t}.parquet").exists() for t in TABLES)
