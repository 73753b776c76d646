"""What every plan must and must not contain, whatever the data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from hazeline.operators.versions import version_history
from hazeline.plans.queries import QUERIES
from tests.compare import DATA
from tests.conftest import plan_of

SMALL = DATA / "sf0.001"
NEVER = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "EvalPython",
    "InPandas",
    "MapInArrow",
)
# Global results: what meets in one task is one row per input task, or one row per date.
ONE_TASK = {
    "current_delta",
    "dq_accepted_values",
    "dq_hourly_gaps",
    "dq_hourly_gaps_repeats",
    "dq_not_null",
    "dq_report",
    "dq_unique",
    "headline_cards",
    "headline_cards_window",
    "metric_options",
    "status_rows",
    "window_kpis",
}

needs_data = pytest.mark.skipif(not SMALL.exists(), reason="no test data here")


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_leaves_the_fast_path(spark, name):
    plan = plan_of(contract.queries()[name](spark, str(SMALL)))
    assert not [bad for bad in NEVER if bad in plan]
    if name not in ONE_TASK:
        assert "SinglePartition" not in plan


@needs_data
@pytest.mark.parametrize(
    "name", ["gold_mart", "gold_mart_by_user", "latest_version_by_user", "latest_shipment_version"]
)
def test_newest_version_is_cut_before_the_shuffle(spark, name):
    plan = plan_of(contract.queries()[name](spark, str(SMALL)))
    assert plan.count("WindowGroupLimit") == 2 * plan.count("+- Window [") > 0


@needs_data
def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(contract.queries()["freshness"](spark, str(SMALL)))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    plan = plan_of(contract.queries()["melt_default_metric"](spark, str(SMALL)))
    assert "PushedFilters: [In(event_type, [click,error,view])]" in plan
    assert "props" not in plan


def test_hot_keys_are_joined_by_hash(spark):
    df = spark.range(3_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("b"))
    plan = plan_of(version_history(df, ["k"], [F.col("b").desc()], hot_key_rows=100))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
