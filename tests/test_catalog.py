"""Registered queries: agreement with DuckDB at the smallest scale, and the shape of their plans."""
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
import check

import __spark_entry__ as entry

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the generated tables")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in check.NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, str(SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = check.rows_of(df.columns, df.collect())
    if name in SQL:
        rel = duck.execute(SQL[name])
        cols = [c[0] for c in rel.description]
        assert sorted(cols) == sorted(df.columns)
        assert got == check.rows_of(cols, rel.fetchall())


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "groups" and df.count() == 1


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["policy_summary"](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)]" in plan
    assert "l_shipdate" not in plan and "o_totalprice" not in plan and "l_extendedprice" not in plan
