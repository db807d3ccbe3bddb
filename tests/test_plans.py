"""Registered queries: oracle agreement at sf0.001 and plan properties."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracles import TABLES, rows_key

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_agreement(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key(ocols, cur.fetchall())


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    out = E.entry(spark)
    assert out.count() >= 0 and "status" in out.columns


@pytest.mark.parametrize("name", ["pipe_label_traffic", "join_conform_latest", "win_forward_fill",
                                  "join_lookup_default", "agg_argmin", "topk_per_group", "ml_assign_fixed"])
def test_no_python_udf_in_plan(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns_and_pushes_filter(spark):
    df = E.queries()["filter_scenario"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_returnflag:string>" in plan
