"""Query-to-credit attribution (the fan-out join of the monitoring reports).

Every query is joined to the metering row of its warehouse and start hour and
receives that hour's WHOLE credit figure.  When an hour holds several queries
the attributed sum over-counts the real credits; this is the reported
behaviour and is kept on purpose (``prorate=True`` gives the share-of-hour
variant instead).

Reports do not join query rows.  ``attributed_groups`` first reduces them to one
row per (warehouse, hour, report keys) with map-side partial sums, joins those
with the hour's credits, and rebuilds the fan-out sums as credits x queries: a
hot warehouse-hour is combined before anything is shuffled, and neither side of
the join grows with the number of queries.  ``attribute`` gives the joined query
rows themselves, for reports on single queries.  No join hint is given: AQE
measures the sides at run time.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.functions.timeutil import hour_floor, ntz, window_start


def query_window(qh: DataFrame, *, wh: str | None = P.WAREHOUSE, as_of: dt.datetime = P.AS_OF,
                 days: int | None = None, success_only: bool = True) -> DataFrame:
    """Warehouse / time-window / success filters (all pushed below the join)."""
    conds = []
    if wh is not None:
        conds.append(F.col("warehouse_name") == wh)
    if days is not None:
        conds.append(F.col("start_time") >= ntz(window_start(as_of, days)))
    if success_only:
        conds.append(F.col("execution_status") == "SUCCESS")
    return qh.filter(reduce(and_, conds)) if conds else qh


def attribute(qh: DataFrame, meter: DataFrame, *, wh: str | None = P.WAREHOUSE,
              as_of: dt.datetime = P.AS_OF, days: int | None = None, success_only: bool = True,
              prorate: bool = False) -> DataFrame:
    """Query rows LEFT JOIN metering on (warehouse, hour of start)."""
    q = query_window(qh, wh=wh, as_of=as_of, days=days, success_only=success_only)
    q = q.withColumn("_hour", F.date_trunc("hour", "start_time"))
    m = meter.select("warehouse_name", F.date_trunc("hour", "start_time").alias("_hour"), "credits_used")
    if wh is not None:
        m = m.filter(F.col("warehouse_name") == wh)
    if days is not None:
        # Only metering hours at or after the first query hour can match.  A
        # metering row starts inside its hour, so this is a plain range filter
        # on start_time that reaches the metering table's scan.
        m = m.filter(F.col("start_time") >= ntz(hour_floor(window_start(as_of, days))))
    if prorate:
        # Share of the hour's credits in proportion to elapsed time; the hour
        # totals are a (warehouse, hour) aggregate, never a per-group window.
        totals = q.groupBy("warehouse_name", "_hour").agg(F.sum("total_elapsed_time").alias("_hour_ms"))
        m = m.join(totals, on=["warehouse_name", "_hour"], how="inner")
    out = q.join(m, on=["warehouse_name", "_hour"], how="left")
    if prorate:
        out = out.withColumn("credits_used", F.col("credits_used").cast("double") * F.col("total_elapsed_time")
                             / F.nullif(F.col("_hour_ms"), F.lit(0))).drop("_hour_ms")
    return out.drop("_hour")


def meter_hours(meter: DataFrame, *, wh: str | None = P.WAREHOUSE, as_of: dt.datetime = P.AS_OF, days: int | None = None, **extra: Column) -> DataFrame:
    """One row per (warehouse, hour): ``_m`` metering rows, ``_credits`` their exact sum, ``_known`` how many have credits, and ``extra`` sums."""
    m = meter if wh is None else meter.filter(F.col("warehouse_name") == wh)
    if days is not None:
        m = m.filter(F.col("start_time") >= ntz(hour_floor(window_start(as_of, days))))
    return (m.groupBy("warehouse_name", F.date_trunc("hour", "start_time").alias("_hour"))
            .agg(F.count(F.lit(1)).alias("_m"), F.sum("credits_used").alias("_credits"), F.count("credits_used").alias("_known"),
                 *(F.sum(c).alias(n) for n, c in extra.items())))


def attributed_groups(qh: DataFrame, meter: DataFrame, keys: dict[str, Column], *, where: Column | None = None, distinct: bool = True,
                      wh: str | None = P.WAREHOUSE, as_of: dt.datetime = P.AS_OF, days: int | None = None,
                      success_only: bool = True, **extra: Column) -> DataFrame:
    """Attribution grouped by ``keys`` without joining query rows.

    Per group: ``rows`` (joined rows), ``query_count`` (distinct ids, with
    ``distinct``), ``elapsed_ms``, ``credits`` (exact decimal sum over the
    fan-out), ``credit_rows`` (joined rows with credits) and ``extra`` sums over
    query rows.  Equal to grouping ``attribute``'s rows, also where an hour
    has several metering rows, which repeat its queries.

    Distinct ids do not depend on the join, so they are counted beside it: one
    shuffle of (keys, query_id), with partial aggregation.
    """
    q = query_window(qh, wh=wh, as_of=as_of, days=days, success_only=success_only)
    if where is not None:
        q = q.filter(where)
    named = [c.alias(n) for n, c in keys.items()]
    hour = F.date_trunc("hour", "start_time").alias("_hour")
    facts = q.groupBy("warehouse_name", hour, *named).agg(F.count(F.lit(1)).alias("_n"), F.sum("total_elapsed_time").alias("_ms"),
                                                         *(F.sum(c).alias(n) for n, c in extra.items()))
    times = F.coalesce(F.col("_m"), F.lit(1))
    out = (facts.join(meter_hours(meter, wh=wh, as_of=as_of, days=days), ["warehouse_name", "_hour"], "left")
           .groupBy(*keys).agg(F.sum(F.col("_n") * times).alias("rows"), F.sum(F.col("_ms") * times).alias("elapsed_ms"),
                               F.sum(F.col("_n") * F.col("_credits")).alias("credits"),
                               F.sum(F.col("_n") * F.coalesce("_known", F.lit(0))).alias("credit_rows"), *(F.sum(n).alias(n) for n in extra)))
    if not distinct:
        return out
    ids = q.groupBy(*named).agg(F.count_distinct("query_id").alias("query_count"))
    a, b = out.alias("a"), ids.alias("b")
    same = reduce(and_, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])  # a row per group on both sides
    return a.join(b, same).select("a.*", "b.query_count")


def costliest(qh: DataFrame, meter: DataFrame, limit: int, *, wh: str | None = P.WAREHOUSE, as_of: dt.datetime = P.AS_OF,
              days: int | None = None) -> DataFrame:
    """The ``limit`` attributed query rows with the largest credits (ties: smallest query_id), without shuffling query rows.

    Queries of an hour share its credits, so hours are ranked first, by credits
    and then by their smallest query_id.  Each ranked hour holds a query, so the
    first ``limit`` hours hold the result; only their queries are fetched, through
    a broadcast of those ``limit`` rows.
    """
    q = query_window(qh, wh=wh, as_of=as_of, days=days).withColumn("_hour", F.date_trunc("hour", "start_time"))
    # Null ids sort first, as in the result.
    hours = q.groupBy("warehouse_name", "_hour").agg(F.max(F.col("query_id").isNull()).alias("_nulls"), F.min("query_id").alias("_first"))
    m = meter if wh is None else meter.filter(F.col("warehouse_name") == wh)
    if days is not None:
        m = m.filter(F.col("start_time") >= ntz(hour_floor(window_start(as_of, days))))
    m = m.filter(F.col("credits_used").isNotNull()).select("warehouse_name", F.date_trunc("hour", "start_time").alias("_hour"), "credits_used")
    best = hours.join(m, ["warehouse_name", "_hour"]).orderBy(F.col("credits_used").desc(), F.col("_nulls").desc(), "_first").limit(limit).drop("_nulls", "_first")
    return (q.join(F.broadcast(best), ["warehouse_name", "_hour"]).drop("_hour")
            .orderBy(F.col("credits_used").desc(), F.col("query_id")).limit(limit))
