"""Every registered query against its SQL counterpart, and the shape of some plans."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from terraloom.plans import registered
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# At the smallest scale no priority has 90 days in a season, so these read larger tables.
LARGER_DIR = "/root/testdata/sf0.01"
NEED_LARGER = {"rolling_90", "gamma_fit", "spi_index"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registered()))
def test_against_sql(spark, duck, name):
    """Names, types and values agree, and no plan compares every row with every row."""
    run, sql = registered()[name]
    larger = name in NEED_LARGER and SF_DIR.endswith("sf0.001")
    df = run(spark, LARGER_DIR if larger else SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert differences(df, connect(LARGER_DIR) if larger else duck, sql) == []


def test_entry_points(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
    assert set(registered()) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def plan_of(spark, name):
    return registered()[name][0](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_scans_are_narrow(spark):
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan_of(spark, "season_stats")
    plan = plan_of(spark, "observation_range")
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_top_rows_are_cut_before_the_shuffle(spark):
    for name in ("latest_checkpoint", "first_n_per_group"):
        assert plan_of(spark, name).index("WindowGroupLimit") > 0 and "Partial" in plan_of(spark, name)


def test_noise_needs_no_shuffle(spark):
    """Steps are unfolded in place: the only exchanges belong to the small fitted tables."""
    body = plan_of(spark, "forward_noise").split("Subquery")[0]
    assert "Exchange" not in body


def test_noise_is_made_by_many_tasks(spark):
    """The parts come from one small file; the tasks that make their noise share them."""
    shares = [r["count"] for r in registered()["forward_noise"][0](spark, SF_DIR).groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) > 1 and max(shares) < 0.6 * sum(shares)
