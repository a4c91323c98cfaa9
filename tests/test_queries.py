"""Registered queries against their SQL, and the shape of their plans.

A few queries of every module run by default; set PANELYARD_ALL=1 for all of them.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from panelyard.workload import ORACLES, QUERIES

SF = os.environ.get("PANELYARD_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
USUAL = ["flagship", "merge_policy", "rank_ties", "feed_dedup", "write_coverage", "closed_copy", "settle_plan",
         "reconcile", "cursor", "gap_islands", "symbol_map", "account_priority", "quarterly_rows", "validate_bars",
         "listing_json", "ticker_lines", "orphan_dates", "change_code", "publish_upsert", "stream_upsert"]
ALL = sorted(QUERIES)
CHOSEN = ALL if os.environ.get("PANELYARD_ALL") else USUAL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def shape(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(columns), sorted(tuple(clean(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, oracle, name):
    df = entry.queries()[name](spark, SF)
    got = shape(df.columns, [tuple(r) for r in df.collect()])
    result = oracle.execute(entry.oracle_sql()[name])
    assert got == shape([c[0] for c in result.description], result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def plan_of(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", USUAL)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "replace_subset")
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,MACHINERY)" in plan
    counts = plan_of(spark, "session_counts")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in counts


def test_keep_one_is_limited_before_the_shuffle(spark):
    plan = plan_of(spark, "feed_dedup")
    assert "WindowGroupLimit" in plan[plan.index("Exchange hashpartitioning"):]


def test_entry_runs(spark):
    assert entry.entry(spark).limit(5).count() == 5
