"""Every registered query runs on the smallest driver tables, and the cheap ones agree with
their DuckDB oracle there (the full sf0.01 comparison is scripts/oracle_check.py)."""

import contextlib
import io

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import digest
from stockroom.sources.tables import DRIVER_TABLES
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def assert_no_pair_joins(df):
    """Scale guard: no plan may pair all rows of two inputs."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "date_id", "daily_delta"]
    assert df.count() > 0


def test_every_query_has_a_unique_name_and_most_have_an_oracle():
    assert len(QUERIES) >= 70
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) / len(QUERIES) > 0.85


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle_on_smallest_tables(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert_no_pair_joins(df)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert_no_pair_joins(df)
    assert df.count() > 0


def _formatted_plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = _formatted_plan(QUERIES["daily_delta"](spark, SF_SMALL))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert schemas and not any("props" in line for line in schemas)  # unused events column
    assert "ReadSchema: struct<p_partkey:bigint>" in schemas
    assert "PushedFilters: [IsNotNull(user_id)]" in plan
    plan = _formatted_plan(QUERIES["replay_state_lineitem"](spark, SF_SMALL))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert len(schemas) == 1 and "l_extendedprice" not in schemas[0] and "l_orderkey" not in schemas[0]
