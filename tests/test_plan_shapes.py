"""Plan-shape regression tests for the scale-critical operators."""

import pytest

import __spark_entry__ as ent
from tools.explain_plans import summary

SMALL = "/root/testdata/sf0.001"


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["join_primary", "join_feature", "completeness_events_month", "runlog_upsert_nodes", "parse_tags",
     "live_partitions", "gate_decision", "scan_partition_window", "classification_metrics", "catalog_exists"],
)
def test_no_cartesian_no_python(spark, name):
    s = summary(_final_plan(ent.queries()[name](spark, SMALL)))
    assert s["cartesian"] == 0 and s["python"] == 0, s


def test_date_join_never_shuffles_left_side(spark):
    plan = _final_plan(ent.queries()["join_primary"](spark, SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "partial_count" in plan                      # right side reduced map-side
    assert "hashpartitioning(created_at" in plan         # only the per-key counts are shuffled
    assert "hashpartitioning(processed_date" not in plan and "hashpartitioning(id" not in plan


def test_completeness_is_bounded_broadcast_anti_join(spark):
    plan = _final_plan(ent.queries()["completeness_events_month"](spark, SMALL))
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


def test_folds_combine_map_side(spark):
    for name in ("runlog_upsert_nodes", "parse_tags"):
        plan = _final_plan(ent.queries()[name](spark, SMALL))
        assert "partial_max_by" in plan, name
        assert "Window" not in plan, name


def test_window_scan_prunes(spark):
    plan = _final_plan(ent.queries()["scan_partition_window"](spark, SMALL))
    assert "PartitionFilters: [isnotnull(processed_date" in plan
