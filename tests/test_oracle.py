"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from check_oracle import connect, difference

from __spark_entry__ import entry
from brokerhouse.plans.oracle import ORACLE_SQL
from brokerhouse.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Joins that pair every row with every other, and Python workers.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    assert difference(df, con, ORACLE_SQL[name]) is None


def test_sums_are_reduced_before_dimension_joins(spark):
    plan = QUERIES["top_instruments"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    above_join, join, below_join = plan.partition("Join LeftOuter")
    assert join and "Aggregate [instrument_id" in below_join and "lineitem" not in above_join
    trades = below_join[below_join.index("Aggregate [instrument_id") :]
    assert "l_extendedprice" in trades and "Join" not in trades[: trades.index("l_extendedprice")]


def test_a_second_load_meets_what_is_there(spark):
    plan = QUERIES["dim_date_second_load"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" in plan


def test_rules_of_a_dataset_share_one_scan(spark):
    plan = QUERIES["dq_trades"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Expand") == 1


def test_changes_are_found_without_ordering_values(spark):
    version = QUERIES["scd2_customer"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in version


def test_entry(spark):
    assert entry(spark).count() > 0
