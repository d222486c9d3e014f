"""Usage and cost reports over query, metering, load and billing logs.

Each report is ``name(logs..., *, wh, as_of, days) -> DataFrame``.  All of
them are filters plus hash aggregations (partial aggregation on the map side,
so a hot warehouse or hour is combined before the shuffle) or ordered top-k
(``TakeOrderedAndProject``: a bounded heap per task, no global sort).

Numeric conventions: credits stay DECIMAL(18,6) through every sum and are
cast to DOUBLE at the end; second-based averages are computed from integer
millisecond sums, so results do not depend on summation order.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.functions.tags import model_path, parse_tag, workload_type
from meterwise.functions.timeutil import diff_units, last_days, ntz, trunc, window_start
from meterwise.operators.attribution import attributed_groups, costliest, query_window


# ---------------------------------------------------------------- helpers ---

def param_value(params: DataFrame, name: str = P.DOLLARS_PER_CREDIT, default: float | None = None) -> Column:
    """Scalar sub-query ``(SELECT param_value FROM params WHERE param_name = name)``."""
    value = params.filter(F.col("param_name") == name).select(F.max("param_value")).scalar()
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def credits_sum(c: str = "credits_used") -> Column:
    return F.sum(c).cast("double")


def credits_avg(c: str = "credits_used") -> Column:
    """AVG(credits) as DOUBLE: exact decimal sum / non-null count."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


def group_credits() -> Column:
    """Attributed credits of an ``attributed_groups`` row, exact until here."""
    return F.col("credits").cast("double")


def group_credits_avg() -> Column:
    return group_credits() / F.nullif(F.col("credit_rows"), F.lit(0))


def group_seconds_avg() -> Column:
    return F.col("elapsed_ms").cast("double") / F.col("rows") / F.lit(1000)


def seconds_avg(ms: str = "total_elapsed_time") -> Column:
    return F.avg(ms) / F.lit(1000)


def meter_window(meter: DataFrame, *, wh: str | None = P.WAREHOUSE, as_of: dt.datetime = P.AS_OF,
                 days: int | None = 7) -> DataFrame:
    conds = [] if wh is None else [F.col("warehouse_name") == wh]
    if days is not None:
        conds.append(F.col("start_time") >= ntz(window_start(as_of, days)))
    return meter.filter(reduce(and_, conds)) if conds else meter


# ------------------------------------------------------------ A1 - A7 -------

def hourly_utilization(meter: DataFrame, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, with_avg=True) -> DataFrame:
    """A1: credits and metering-row count per warehouse hour."""
    aggs = [credits_sum().alias("total_credits"), F.count(F.lit(1)).alias("execution_count")]
    if with_avg:
        aggs.append(F.round(credits_avg(), 6).alias("avg_credits_per_execution"))
    return (meter_window(meter, wh=wh, as_of=as_of, days=days)
            .groupBy("warehouse_name", trunc("hour", "start_time").alias("hour"))
            .agg(*aggs)
            .orderBy(F.col("hour").desc()))


def queuing_periods(load: DataFrame, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, limit=100) -> DataFrame:
    """A2: newest load periods with queued or blocked queries."""
    return (last_days(load.filter(F.col("warehouse_name") == wh), "start_time", days, as_of)
            .filter((F.col("avg_queued_load") > 0) | (F.col("avg_blocked") > 0))
            .select("warehouse_name", "start_time", "end_time",
                    F.col("avg_running").alias("average_running_queries"),
                    F.col("avg_queued_load").alias("average_queued_queries"),
                    F.col("avg_queued_provisioning").alias("average_queued_for_provisioning"),
                    F.col("avg_blocked").alias("average_blocked_queries"))
            .orderBy(F.col("start_time").desc())
            .limit(limit))


def warehouse_load(load: DataFrame, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """A2 dashboard variant: every load period of the window."""
    return (last_days(load.filter(F.col("warehouse_name") == wh), "start_time", days, as_of)
            .select("start_time", "end_time",
                    F.col("avg_running").alias("avg_running_queries"),
                    F.col("avg_queued_load").alias("avg_queued_queries"),
                    "avg_queued_provisioning", "avg_blocked")
            .orderBy("start_time"))


def cost_by_workload(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=14) -> DataFrame:
    """A3: attributed credits per workload type."""
    price = param_value(params)
    return (attributed_groups(qh, meter, {"workload_type": workload_type()}, wh=wh, as_of=as_of, days=days)
            .select("workload_type", "query_count",
                    F.round(F.col("elapsed_ms") / F.lit(3600000.0), 6).alias("total_execution_hours"),
                    group_credits().alias("total_credits"),
                    F.round(group_credits_avg(), 6).alias("avg_credits_per_query"),
                    F.round(group_credits() * price, 6).alias("estimated_cost_dollars"))
            .orderBy(F.col("total_credits").desc_nulls_last()))


def path_groups(qh, meter, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Attribution per workload type and model path: A4, D3, D4 and D5 all derive from it, so a job computes it once."""
    return attributed_groups(qh, meter, {"workload_type": workload_type(), "model_path": model_path()}, wh=wh, as_of=as_of, days=days)


def cost_by_workload_path(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, groups: DataFrame | None = None) -> DataFrame:
    """A4: attributed credits per workload type and model path, rounded (from ``groups`` if given)."""
    price = param_value(params)
    return ((groups if groups is not None else path_groups(qh, meter, wh=wh, as_of=as_of, days=days))
            .select("workload_type", "model_path", "query_count",
                    F.round(F.col("elapsed_ms") / F.lit(3600000.0), 2).alias("total_execution_hours"),
                    F.round("credits", 4).cast("double").alias("total_credits"),
                    F.round(group_credits_avg(), 6).alias("avg_credits_per_query"),
                    F.round(group_credits() * price, 2).alias("estimated_cost_dollars"))
            .orderBy(F.col("total_credits").desc_nulls_last()))


def path_comparison(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=14) -> DataFrame:
    """A5: tagged model paths only, COUNT(*) per path and workload."""
    price = param_value(params)
    keys = {"model_path": model_path(default=None), "workload_type": workload_type(classes=("TRAINING", "INFERENCE"), default=None)}
    known = reduce(and_, [k.isNotNull() for k in keys.values()])
    return (attributed_groups(qh, meter, keys, where=known, distinct=False, wh=wh, as_of=as_of, days=days)
            .select("model_path", "workload_type", F.col("rows").alias("execution_count"),
                    F.round(group_seconds_avg(), 2).alias("avg_seconds"),
                    F.round("credits", 4).cast("double").alias("total_credits"),
                    F.round(group_credits() * price, 2).alias("total_cost_dollars"),
                    F.round(group_credits_avg() * price, 4).alias("avg_cost_per_run_dollars"))
            .orderBy("model_path", "workload_type"))


def path_workload_comparison(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=14) -> DataFrame:
    """Paths other than OTHER, per path and (two-class) workload."""
    price = param_value(params)
    keys = {"model_path": model_path(), "workload_type": workload_type(classes=("TRAINING", "INFERENCE"), default="OTHER")}
    return (attributed_groups(qh, meter, keys, where=F.col("query_tag").isNotNull() & (keys["model_path"] != P.PATH_DEFAULT),
                              wh=wh, as_of=as_of, days=days)
            .select("model_path", "workload_type", "query_count",
                    F.round(group_seconds_avg(), 2).alias("avg_execution_seconds"),
                    F.round("credits", 4).cast("double").alias("total_credits"),
                    F.round(group_credits_avg(), 6).alias("avg_credits_per_query"),
                    F.round(group_credits() * price, 2).alias("estimated_cost_dollars"))
            .orderBy("model_path", "workload_type"))


def daily_credit_trend(meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=30) -> DataFrame:
    """Credits and cost per day."""
    price = param_value(params)
    return (meter_window(meter, wh=wh, as_of=as_of, days=days)
            .groupBy(F.col("start_time").cast("date").alias("date"), "warehouse_name")
            .agg(credits_sum().alias("daily_credits"))
            .withColumn("daily_cost_dollars", F.round(F.col("daily_credits") * price, 6))
            .orderBy(F.col("date").desc()))


# ----------------------------------------------------------- A8 - A16 -------

def longest_queries(qh, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, limit=20) -> DataFrame:
    """Slowest successful queries with the queue breakdown in seconds."""
    return (query_window(qh, wh=wh, as_of=as_of, days=days)
            .orderBy(F.col("total_elapsed_time").desc(), F.col("query_id"))
            .limit(limit)
            .select("query_id", "query_tag", "user_name", "warehouse_name", "start_time", "end_time",
                    (F.col("total_elapsed_time") / 1000).alias("execution_time_seconds"),
                    (F.col("queued_provisioning_time") / 1000).alias("queue_provision_seconds"),
                    (F.col("queued_repair_time") / 1000).alias("queue_repair_seconds"),
                    (F.col("queued_overload_time") / 1000).alias("queue_overload_seconds"),
                    "bytes_scanned", "rows_produced"))


def query_performance(qh, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7,
                      limit: int | None = 100) -> DataFrame:
    """A8 dashboard variant: the slowest ``limit`` queries with GB scanned and a three-class workload (None: all, unordered)."""
    wl = workload_type(default="OTHER")
    queries = query_window(qh, wh=wh, as_of=as_of, days=days)
    if limit is not None:
        queries = queries.orderBy(F.col("total_elapsed_time").desc(), F.col("query_id")).limit(limit)
    return (queries
            .select("query_id", "query_tag", "user_name", "start_time",
                    (F.col("total_elapsed_time") / 1000).alias("execution_time_seconds"),
                    (F.col("queued_overload_time") / 1000).alias("queue_time_seconds"),
                    (F.col("bytes_scanned") / F.lit(1073741824.0)).alias("gb_scanned"),
                    "rows_produced", wl.alias("workload_type")))


def expensive_queries(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, limit=20) -> DataFrame:
    """Queries with the largest attributed credits (ties broken by id); hours are ranked before queries are fetched."""
    price = param_value(params)
    return (costliest(qh, meter, limit, wh=wh, as_of=as_of, days=days)
            .select("query_id", "query_tag", F.substring("query_text", 1, 100).alias("query_preview"),
                    "user_name", "start_time",
                    (F.col("total_elapsed_time") / 1000).alias("execution_time_seconds"),
                    F.col("credits_used").cast("double").alias("credits_used"),
                    F.round(F.col("credits_used").cast("double") * price, 6).alias("estimated_cost_dollars")))


def hour_of_day(qh, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """A10: query count, mean seconds and queued count per hour of day."""
    return (query_window(qh, wh=wh, as_of=as_of, days=days)
            .groupBy(F.hour("start_time").alias("hour_of_day"))
            .agg(F.count(F.lit(1)).alias("query_count"),
                 seconds_avg().alias("avg_execution_seconds"),
                 F.sum(F.when(F.col("queued_overload_time") > 0, 1).otherwise(0)).cast("bigint")
                 .alias("queries_queued"))
            .orderBy("hour_of_day"))


def idle_time(qh, meter, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Metered hours minus summed query hours (can be negative)."""
    sessions = (meter_window(meter, wh=wh, as_of=as_of, days=days)
                .groupBy("warehouse_name")
                .agg((F.sum(diff_units("second", "start_time", "end_time")) / F.lit(3600.0))
                     .alias("total_warehouse_hours"),
                     F.sum("credits_used").cast("double").alias("total_credits")))
    active = (query_window(qh, wh=wh, as_of=as_of, days=days)
              .groupBy("warehouse_name")
              .agg((F.sum("total_elapsed_time") / F.lit(1000.0) / F.lit(3600.0)).alias("active_query_hours")))
    # Both sides are one row per warehouse.
    idle = F.col("total_warehouse_hours") - F.col("active_query_hours")
    share = idle / F.nullif(F.col("total_warehouse_hours"), F.lit(0.0))
    return (sessions.join(active, "warehouse_name")
            .select("warehouse_name", "total_warehouse_hours", "active_query_hours",
                    idle.alias("idle_hours"),
                    F.round(F.lit(100.0) * share, 2).alias("idle_percentage"),
                    "total_credits",
                    F.round(F.col("total_credits") * share, 4).alias("estimated_idle_credits")))


def auto_suspend(meter, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Metering sessions per day with their length in seconds."""
    secs = diff_units("second", "start_time", "end_time")
    return (meter_window(meter, wh=wh, as_of=as_of, days=days)
            .groupBy("warehouse_name", F.col("start_time").cast("date").alias("date"))
            .agg(F.count(F.lit(1)).alias("session_count"),
                 F.avg(secs).alias("avg_session_duration_seconds"),
                 F.min(secs).alias("min_session_duration_seconds"),
                 F.max(secs).alias("max_session_duration_seconds"))
            .orderBy(F.col("date").desc()))


def _workload_runs(qh, workload: str, *, wh, as_of, days) -> DataFrame:
    return query_window(qh, wh=wh, as_of=as_of, days=days).filter(F.col("query_tag").contains(f"WORKLOAD:{workload}"))


def training_runs(qh, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=30) -> DataFrame:
    """Training jobs per day."""
    return (_workload_runs(qh, "TRAINING", wh=wh, as_of=as_of, days=days)
            .groupBy(F.col("start_time").cast("date").alias("training_date"))
            .agg(F.count(F.lit(1)).alias("training_runs"),
                 seconds_avg().alias("avg_training_seconds"),
                 (F.max("total_elapsed_time") / 1000).alias("max_training_seconds"),
                 (F.sum("bytes_scanned") / F.lit(1073741824.0)).alias("total_gb_scanned"))
            .orderBy(F.col("training_date").desc()))


def inference_runs(qh, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=30) -> DataFrame:
    """Inference jobs per day."""
    return (_workload_runs(qh, "INFERENCE", wh=wh, as_of=as_of, days=days)
            .groupBy(F.col("start_time").cast("date").alias("inference_date"))
            .agg(F.count(F.lit(1)).alias("inference_runs"),
                 seconds_avg().alias("avg_inference_seconds"),
                 (F.min("total_elapsed_time") / 1000).alias("min_inference_seconds"),
                 (F.max("total_elapsed_time") / 1000).alias("max_inference_seconds"),
                 F.avg("rows_produced").alias("avg_rows_forecasted"))
            .orderBy(F.col("inference_date").desc()))


def executive_summary(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Five headline figures as (category, name, value, cost) rows.

    One conditional-aggregate pass over each log replaces the five scans of
    the UNION ALL form; ``stack`` turns the single row into five.
    """
    price = param_value(params)
    credits = (meter_window(meter, wh=wh, as_of=as_of, days=days)
               .select(F.sum("credits_used").cast("double")).scalar())
    tag = F.col("query_tag")
    q = (query_window(qh, wh=wh, as_of=as_of, days=days)
         .agg(F.count(F.lit(1)).cast("double").alias("queries"),
              F.round(seconds_avg(), 2).alias("avg_secs"),
              F.count_if(tag.contains("WORKLOAD:TRAINING")).cast("double").alias("training"),
              F.count_if(tag.contains("WORKLOAD:INFERENCE")).cast("double").alias("inference")))
    null = "CAST(NULL AS DOUBLE)"
    both = (q.withColumn("credits", F.round(credits, 2))
            .withColumn("cost", F.round(credits * price, 2)))
    return (both.selectExpr(
        "stack(5, "
        "'Warehouse Overview', 'Total Credits Used', credits, cost, "
        f"'Query Performance', 'Total Queries Executed', queries, {null}, "
        f"'Query Performance', 'Average Query Time (seconds)', avg_secs, {null}, "
        f"'Workload Attribution', 'Training Runs', training, {null}, "
        f"'Workload Attribution', 'Inference Runs', inference, {null}"
        ") AS (metric_category, metric_name, metric_value, cost_dollars)")
        .orderBy("metric_category", "metric_name"))


def recent_sessions(meter, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, limit=20) -> DataFrame:
    """Newest metering sessions with minutes and credits per hour."""
    hours = diff_units("hour", "start_time", "end_time")
    return (meter_window(meter, wh=wh, as_of=as_of, days=days)
            .orderBy(F.col("start_time").desc())
            .limit(limit)
            .select("warehouse_name", "start_time", "end_time",
                    F.col("credits_used").cast("double").alias("credits_used"),
                    diff_units("minute", "start_time", "end_time").alias("duration_minutes"),
                    F.round(F.col("credits_used").cast("double") / F.nullif(hours, F.lit(0)), 4)
                    .alias("credits_per_hour")))


# ---------------------------------------------------------- A17 - A23 -------

def lifetime_usage(meter, params, *, wh=P.WAREHOUSE) -> DataFrame:
    """First and last use, credits and cost over the whole log."""
    price = param_value(params)
    return (meter.filter(F.col("warehouse_name") == wh)
            .groupBy("warehouse_name")
            .agg(F.min("start_time").alias("first_usage"), F.max("end_time").alias("last_usage"),
                 credits_sum().alias("total_credits"))
            .withColumn("estimated_total_cost_dollars", F.round(F.col("total_credits") * price, 2)))


def lifetime_by_workload(qh, meter, params, *, wh=P.WAREHOUSE) -> DataFrame:
    """Attributed credits per workload, no time bound, COUNT(*)."""
    price = param_value(params)
    return (attributed_groups(qh, meter, {"workload_type": workload_type()}, distinct=False, wh=wh)
            .select("workload_type", F.col("rows").alias("query_count"),
                    F.round("credits", 4).cast("double").alias("total_credits"),
                    F.round(group_credits() * price, 2).alias("estimated_cost_dollars"))
            .orderBy(F.col("total_credits").desc_nulls_last()))


def credits_per_hour(meter, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Credits / metered hours (minutes counted by boundaries)."""
    minutes = diff_units("minute", "start_time", "end_time")
    return (meter_window(meter, wh=wh, as_of=as_of, days=days)
            .agg(F.round(F.sum("credits_used").cast("double")
                         / F.nullif(F.sum(minutes) / F.lit(60), F.lit(0.0)), 3).alias("credits_per_hour")))


def price_per_credit(billing, *, as_of_date: dt.date = P.AS_OF_DATE, months: int = 3) -> DataFrame:
    """Billed dollars per credit for the last months."""
    since = F.add_months(F.lit(as_of_date), -months)
    return (billing.filter(F.col("statement_date") >= since)
            .select("statement_date",
                    F.col("credits_used").cast("double").alias("credits_used"),
                    F.col("amount_due").cast("double").alias("amount_due"),
                    F.round(F.col("amount_due").cast("double")
                            / F.nullif(F.col("credits_used").cast("double"), F.lit(0.0)), 4)
                    .alias("dollars_per_credit"))
            .orderBy(F.col("statement_date").desc()))


def expected_runtime(qh, *, pattern: str = "%job_purchase%", as_of=P.AS_OF, days=7) -> DataFrame:
    """Mean minutes of past runs whose text matches ``pattern``."""
    return (last_days(qh, "start_time", days, as_of)
            .filter(F.col("query_text").ilike(pattern))
            .agg(F.avg(diff_units("minute", "start_time", "end_time")).alias("avg_minutes")))


def weekly_summary(weekly: DataFrame) -> DataFrame:
    """Total plays and distinct tracks per region and week."""
    return (weekly.groupBy("region", "week_ending")
            .agg(F.sum("streams").cast("bigint").alias("total_streams"),
                 F.count_distinct("isrc").alias("track_count")))


def scheduled_attribution(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=14) -> DataFrame:
    """Attributed credits split by workload and the SCHEDULED flag."""
    price = param_value(params)
    keys = {"workload_type": workload_type(), "is_scheduled": parse_tag()[2]}
    return (attributed_groups(qh, meter, keys, wh=wh, as_of=as_of, days=days)
            .select("workload_type", "is_scheduled", "query_count",
                    F.round("credits", 4).cast("double").alias("total_credits"),
                    F.round(group_credits() * price, 2).alias("estimated_cost_dollars"))
            .orderBy("workload_type", "is_scheduled"))


def classify_tags(qh: DataFrame) -> DataFrame:
    """Every classification variant side by side."""
    return qh.select(
        "query_id",
        workload_type().alias("workload_type"),
        model_path().alias("model_path"),
        workload_type(classes=("TRAINING", "INFERENCE"), default="OTHER").alias("workload_two"),
        workload_type(default="OTHER").alias("workload_dashboard"),
        model_path(default=None).alias("model_path_or_null"),
    )


def parse_tags(qh: DataFrame) -> DataFrame:
    """P5: tag fields as columns."""
    return qh.select("query_id", "query_tag", *parse_tag())


def recent_successful(qh: DataFrame, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Successful tagged queries of one warehouse in the window."""
    return (query_window(qh, wh=wh, as_of=as_of, days=days)
            .filter(F.col("query_tag").isNotNull() & (F.col("query_tag") != "WORKLOAD:DATA_PREP"))
            .select("query_id", "warehouse_name", "start_time", "query_tag"))


def text_search(qh: DataFrame, pattern: str = "%JOB_VIEW%") -> DataFrame:
    """Case-insensitive text match."""
    return qh.filter(F.col("query_text").ilike(pattern)).select("query_id", "query_text")
