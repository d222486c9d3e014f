"""Plan properties: pushdown, join strategy, no Python UDFs, shared window sorts."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from meterwise.operators.features import training_features
from meterwise.plans import registry
from meterwise.sources.weekly import weekly_input
from tests.conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df, mode="formatted") -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


@pytest.mark.parametrize("name", sorted(set(registry()) - {"gbt_scores", "forecast_boosted", "forecast_boosted_frame",
                                                            "stream_hourly_usage", "stream_incremental_metering", "stream_closed_hours"}))
def test_no_python_udfs(spark, name):
    text = plan_text(E.queries()[name](spark, SF_SMALL), "extended")
    assert not any(node in text for node in PY_NODES)


def test_time_filter_reaches_events_scan(spark):
    text = plan_text(E.queries()["cost_by_workload_path"](spark, SF_SMALL))
    # Both the query side and the metering side prune the events scan by time.
    assert text.count("PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-24T00:00)]") >= 2


def test_attribution_join_is_hash_join_on_both_keys(spark):
    df = E.queries()["cost_by_workload_path"](spark, SF_SMALL)
    df.collect()
    text = plan_text(df)
    assert "BroadcastHashJoin" in text and "LeftOuter" in text


def test_column_pruning_on_metering_scan(spark):
    text = plan_text(E.queries()["hourly_utilization"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_training_windows_share_one_shuffle(spark):
    text = plan_text(training_features(weekly_input(spark, SF_SMALL, region="Global")), "simple")
    assert "Join" not in text.split("BroadcastHashJoin")[0]  # no semi-join above the weekly input
    assert "LeftSemi" not in text
    assert text.count("Exchange hashpartitioning(isrc") == 1
    assert text.count("Sort [isrc") == 1


def test_weekly_input_single_lineitem_scan(spark):
    text = plan_text(weekly_input(spark, SF_SMALL), "simple")
    assert text.count("lineitem.parquet") == 1
    assert "Expand" in text


# Reports bounded by a trailing window: the bound must reach the events scan.
WINDOWED = ["hourly_utilization", "queuing_periods", "warehouse_load", "cost_by_workload", "cost_by_workload_path",
            "path_comparison", "path_workload_comparison", "daily_credit_trend", "longest_queries",
            "query_performance", "expensive_queries", "hour_of_day", "idle_time", "auto_suspend", "training_runs",
            "inference_runs", "executive_summary", "recent_sessions", "credits_per_hour", "expected_runtime",
            "scheduled_attribution", "recent_successful", "dashboard_kpis", "queue_alert", "workload_costs",
            "path_costs", "cost_breakdown", "spend_stats", "slowest_queries", "workload_perf", "runtime_histogram",
            "queued_queries", "recommendations", "kpi_status", "estimate_scenarios"]


@pytest.mark.parametrize("name", WINDOWED)
def test_window_bound_is_pushed_to_events_scan(spark, name):
    text = plan_text(E.queries()[name](spark, SF_SMALL))
    scans = [line for part in text.split("\n\n") if "events.parquet" in part for line in part.splitlines() if line.startswith("PushedFilters")]
    assert scans and all("GreaterThanOrEqual(ts," in line for line in scans), scans


def test_regions_prune_the_stored_table(spark):
    text = plan_text(E.queries()["stored_weekly_pruned"](spark, SF_SMALL))
    stored = next(part for part in text.split("\n\n") if "weekly_by_region" in part and "PartitionFilters" in part)
    assert "dynamicpruning" in stored
