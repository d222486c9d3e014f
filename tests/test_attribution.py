"""Attribution reduced before the join: equal to the joined rows, and no query row on a (warehouse, hour) exchange."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from meterwise.functions.tags import model_path, workload_type
from meterwise.operators.attribution import attribute, attributed_groups, costliest
from meterwise.operators.dashboard import kpi_status
from tests.conftest import SF_SMALL
from tests.test_plans import plan_text

J1 = ["cost_by_workload", "cost_by_workload_path", "path_comparison", "path_workload_comparison", "expensive_queries", "lifetime_by_workload",
      "scheduled_attribution", "workload_costs", "path_costs", "cost_breakdown"]


@pytest.fixture(scope="module")
def odd_logs(spark):
    """Repeated ids over hours and tags, hours with no, several or null metering rows, a hot hour, null tags and ids."""
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 25)
    tags = [None, "", "WORKLOAD:TRAINING|PATH:NATIVE", "WORKLOAD:INFERENCE", "WORKLOAD:INFERENCE|PATH:BOOSTED", "x"]
    queries = []
    for i in range(900):
        hour = 5 if i % 3 == 0 else rng.randint(0, 60)
        queries.append((None if i % 97 == 0 else rng.randint(0, 500), rng.choice(["FORECAST_WH", "AUX_WH"]) if hour != 5 else "FORECAST_WH",
                        start + dt.timedelta(hours=hour, seconds=rng.randint(0, 3599)), rng.randint(0, 10 ** 6), rng.choice(["SUCCESS", "SUCCESS", "FAIL"]),
                        rng.choice(tags), f"text {i}", f"u{i % 5}"))
    meter = []
    for hour in range(60):
        for w in ("FORECAST_WH", "AUX_WH"):
            for k in range(rng.choice([0, 1, 1, 2])):
                at = start + dt.timedelta(hours=hour, minutes=7 * k)
                meter.append((w, at, at, rng.choice([None, "1.500000", "0.123457", "2.000001"])))
    q = spark.createDataFrame(queries, "query_id long, warehouse_name string, start_time timestamp_ntz, total_elapsed_time long, execution_status string, "
                                       "query_tag string, query_text string, user_name string")
    m = spark.createDataFrame(meter, "warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz, c string")
    return q, m.withColumn("credits_used", F.col("c").cast("decimal(18,6)")).drop("c")


@pytest.mark.parametrize("wh,days", [("FORECAST_WH", None), (None, 5), ("AUX_WH", 4)])
def test_groups_equal_grouped_rows(odd_logs, wh, days):
    q, m = odd_logs
    keys = {"workload_type": workload_type(), "model_path": model_path(default=None)}
    got = attributed_groups(q, m, keys, wh=wh, days=days, as_of=dt.datetime(2024, 1, 30, 10, 30))
    want = (attribute(q, m, wh=wh, days=days, as_of=dt.datetime(2024, 1, 30, 10, 30)).groupBy(*[c.alias(n) for n, c in keys.items()])
            .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("query_id").alias("query_count"), F.sum("total_elapsed_time").alias("elapsed_ms"),
                 F.sum("credits_used").alias("credits"), F.count("credits_used").alias("credit_rows")))
    columns = ["workload_type", "model_path", "rows", "query_count", "elapsed_ms", "credits", "credit_rows"]
    rows = [sorted(map(tuple, df.select(*columns).collect()), key=repr) for df in (got, want)]
    assert len(rows[0]) == 4 and [r[:5] + r[6:] for r in rows[0]] == [r[:5] + r[6:] for r in rows[1]]
    assert [r[5] for r in rows[0]] == [r[5] for r in rows[1]]  # decimals of different scale compare by value


@pytest.mark.parametrize("tagged_only", [False, True])
def test_kpi_untagged_share_of_queries_and_of_attributed_credits(odd_logs, tagged_only):
    q, m = odd_logs
    q = q.withColumn("queued_overload_time", F.lit(1))
    if tagged_only:
        q = q.where("query_tag like '%WORKLOAD%'")
    as_of = dt.datetime(2024, 1, 30, 10, 30)
    untagged = workload_type() == "UNTAGGED"
    rows = attribute(q, m, days=5, as_of=as_of).withColumn("c", F.col("credits_used").cast("double"))
    credits = rows.agg(100 * F.sum(F.when(untagged, F.col("c")).otherwise(0.0)) / F.sum("c")).first()[0]
    queries = q.where("warehouse_name = 'FORECAST_WH' and execution_status = 'SUCCESS' and start_time >= timestamp_ntz'2024-01-25 10:30:00'")
    share = queries.agg(100 * F.avg(untagged.cast("double"))).first()[0]
    got = {r["kpi"]: r for r in kpi_status(q, m, as_of=as_of, days=5).collect()}
    assert got["untagged_pct"]["value"] == pytest.approx(share, abs=0.006)
    assert got["untagged_pct"]["value_by_credits"] == pytest.approx(credits, abs=0.006)
    assert tagged_only == (credits == 0) and (tagged_only or abs(credits - share) > 0.02)
    assert len(got) == 5 and all(r["value_by_credits"] is None for k, r in got.items() if k != "untagged_pct")


@pytest.mark.parametrize("limit", [1, 7, 60, 5000])
def test_costliest_equals_sorted_rows(odd_logs, limit):
    q, m = odd_logs
    got = [(r["credits_used"], r["query_id"]) for r in costliest(q, m, limit).collect()]
    rows = attribute(q, m).where("credits_used is not null").select("credits_used", "query_id").collect()
    want = sorted(((r[0], r[1]) for r in rows), key=lambda r: (-r[0], r[1] is not None, r[1] or 0))[:limit]
    assert got == want


@pytest.mark.parametrize("name", J1)
def test_no_query_row_is_shuffled_by_warehouse_hour(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_text(E.queries()[name](spark, SF_SMALL), "simple").splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    by_hour = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(warehouse_name" in line]
    # What is dealt by hour was aggregated by hour just below (a projection or filter may lie between), so no query row is.
    assert by_hour and all(any("Aggregate(key" in line and "=[warehouse_name" in line for line in lines[i + 1:i + 4]) for i in by_hour)
