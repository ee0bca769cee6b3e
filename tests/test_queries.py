"""Registered queries against their SQL on the smallest supplied tables, and their plans."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks import bindings, registry
from checks.compare import difference, duck, type_difference

from conftest import plan_of

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="supplied tables not here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    want = con.sql(entry.oracle_sql()[name])
    assert difference(df.toPandas(), want.df()) is None
    assert type_difference(df.dtypes, want) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 4


LAZY = ("funnel", "daily_kpi", "channel_summary", "cohort_retention", "session_summary", "user_base", "product_summary")


@pytest.mark.parametrize("name", LAZY)
def test_plans_spread_and_use_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    physical = plan[plan.index("== Physical Plan ==") :]
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in physical
    if name != "funnel":  # its last step adds up five numbers
        assert "SinglePartition" not in physical


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(entry.queries()["product_summary"](spark, FOLDER))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "l_tax" in physical and "l_orderkey" not in physical and "p_brand" not in physical


def test_lines_are_reduced_before_the_join(spark):
    """With a large ``part`` the join shuffles all lines."""
    plan = bindings.items(spark, FOLDER)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    names = plan.children().head().output().mkString(" ")
    assert "item_revenue" in names
    assert not any(c in names for c in ("l_extendedprice", "l_discount", "l_tax", "l_returnflag"))
