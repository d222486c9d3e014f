"""Budget monitors: monthly status and threshold crossings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.functions.timeutil import ntz


def _month_bounds(as_of: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    start = as_of.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    end = (start.replace(year=start.year + 1, month=1) if start.month == 12
           else start.replace(month=start.month + 1))
    return start, end


def budget_status(meter: DataFrame, *, quota: float = P.MONTHLY_QUOTA, wh: str = P.WAREHOUSE,
                  name: str = P.BUDGET_NAME, as_of: dt.datetime = P.AS_OF) -> DataFrame:
    """M1: quota, used, remaining and percent used in the month holding ``as_of``.

    ``as_of`` itself is the exclusive end of the reporting run, so a run at
    midnight on the 1st reports the month that just ended.
    """
    start, end = _month_bounds(as_of - dt.timedelta(microseconds=1))
    used = F.coalesce(F.sum("credits_used").cast("double"), F.lit(0.0))
    return (meter.filter((F.col("warehouse_name") == wh) & (F.col("start_time") >= ntz(start))
                         & (F.col("start_time") < ntz(end)))
            .agg(used.alias("used_credits"))
            .select(F.lit(name).alias("monitor_name"), F.lit(float(quota)).alias("credit_quota"),
                    "used_credits", (F.lit(float(quota)) - F.col("used_credits")).alias("remaining_credits"),
                    F.round(F.lit(100.0) * F.col("used_credits") / F.lit(float(quota)), 2).alias("percent_used"),
                    F.lit("MONTHLY").alias("frequency"), ntz(start).alias("start_time"), ntz(end).alias("end_time")))


def budget_crossings(meter: DataFrame, *, quota: float = P.MONTHLY_QUOTA, wh: str = P.WAREHOUSE,
                     name: str = P.BUDGET_NAME, thresholds=P.BUDGET_THRESHOLDS) -> DataFrame:
    """M2: first time each month's running credits reach each threshold.

    The running sum is a window per month over hourly metering rows (at most
    744 rows per warehouse-month, however many queries ran); crossings are
    conditional minima of one aggregation, unpivoted with ``stack``.
    """
    month = F.date_trunc("month", "start_time")
    w = Window.partitionBy("_month").orderBy("start_time").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = (meter.filter(F.col("warehouse_name") == wh)
               .select(month.alias("_month"), "start_time", "credits_used")
               .select("_month", "start_time", F.sum("credits_used").over(w).alias("running")))
    aggs = [F.min(F.when(F.col("running").cast("double") >= F.lit(t * quota / 100.0), F.col("start_time")))
            .alias(f"t{t}") for t, _ in thresholds]
    stacked = ", ".join(f"{t}, '{action}', t{t}" for t, action in thresholds)
    return (running.groupBy("_month").agg(*aggs)
            .selectExpr(f"stack({len(thresholds)}, {stacked}) AS (threshold, trigger_type, trigger_time)")
            .filter(F.col("trigger_time").isNotNull())
            .select(F.lit(name).alias("resource_monitor_name"), F.col("threshold").cast("int").alias("threshold"),
                    "trigger_type", "trigger_time")
            .orderBy(F.col("trigger_time").desc(), F.col("threshold").desc()))
