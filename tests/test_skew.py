"""A hot key holding a third of all rows: results stay exact, and AQE splits the hot partition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterwise.operators.attribution import attribute
from meterwise.sources.logs import metering_history, query_history
from meterwise.sources.tables import read_table
from tests.conftest import SF_MID


def _skewed_history(spark):
    """Query rows of sf0.01 plus copies piled into one (warehouse, hour) until it holds > 1/3."""
    events = read_table(spark, SF_MID, "events")
    n = events.count()
    copies = (spark.range(n // 2 + 1).select(
        (F.col("id") + 10_000_000).alias("event_id"),
        F.lit(dt.datetime(2024, 1, 29, 13, 30)).cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("bigint").alias("user_id"),
        F.lit("purchase").alias("event_type"),
        (F.col("id") % 50 + 1).cast("double").alias("value"),
        F.lit('{"k": 2}').alias("props")))
    return query_history(events.unionByName(copies))


def test_hot_warehouse_hour_is_split_and_exact(spark):
    qh = _skewed_history(spark)
    meter = metering_history(qh)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        att = attribute(qh, meter, days=None)
        total = att.agg(F.count(F.lit(1)).alias("n"), F.sum("credits_used").alias("c"))
        got = total.first()
        plan = att._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        att.collect()  # runs this DataFrame's own plan, so AQE finalises it
        final = att._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in plan
    assert "skew=true" in final
    # Exactness: the same totals as an independent per-hour computation.
    hours = meter.filter(F.col("warehouse_name") == "FORECAST_WH").select(
        "warehouse_name", F.date_trunc("hour", "start_time").alias("h"), "credits_used")
    per_query = (qh.filter((F.col("warehouse_name") == "FORECAST_WH") & (F.col("execution_status") == "SUCCESS"))
                 .groupBy("warehouse_name", F.date_trunc("hour", "start_time").alias("h")).count())
    want = per_query.join(hours, ["warehouse_name", "h"]).agg(
        F.sum("count").alias("n"), F.sum(F.col("credits_used") * F.col("count")).alias("c")).first()
    assert got["n"] == want["n"]
    assert float(got["c"]) == float(want["c"])
