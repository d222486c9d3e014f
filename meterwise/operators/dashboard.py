"""Dashboard figures, alerts and rule-based recommendations.

The dashboard computes these with pandas after pulling report results to one
process; here each figure is a Spark aggregate over the report DataFrame, and
single numbers enter other expressions as scalar sub-queries (evaluated once,
no cross join).  Statistics run over the whole window as partial + final hash
aggregates; only the query lists are cut to their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.functions.tags import workload_type
from meterwise.functions.timeutil import diff_units, ntz, window_start
from meterwise.operators.attribution import attributed_groups, meter_hours, query_window
from meterwise.operators.reports import meter_window, param_value, path_groups, query_performance, warehouse_load
from meterwise.operators.selection import median


# --------------------------------------------------------- sources (dash) ---

def cost_by_workload_dash(qh, meter, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, groups: DataFrame | None = None) -> DataFrame:
    """Dashboard cost table: per workload and path, credits kept exact (decimal), from ``path_groups`` computed here or given."""
    return ((groups if groups is not None else path_groups(qh, meter, wh=wh, as_of=as_of, days=days))
            .select("workload_type", "model_path", "query_count",
                    (F.col("elapsed_ms") / F.lit(3600000.0)).alias("total_execution_hours"), F.col("credits").alias("total_credits")))


# ---------------------------------------------------------------- D1 - D6 ---

def dashboard_kpis(meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Total credits, cost, executions, mean credits of the metered hours."""
    price = param_value(params, default=P.PARAM_DEFAULTS[P.DOLLARS_PER_CREDIT])
    m = meter_window(meter, wh=wh, as_of=as_of, days=days)
    total = F.sum("credits_used").cast("double")
    hours = F.count_distinct(F.date_trunc("hour", "start_time"))
    return (m.agg(total.alias("total_credits"), F.count(F.lit(1)).alias("total_executions"),
                  (total / F.nullif(hours, F.lit(0))).alias("_avg"))
            .select("total_credits", F.round(F.col("total_credits") * price, 6).alias("total_cost"),
                    "total_executions", F.round("_avg", 6).alias("avg_credits_per_hour")))


def queue_alert(load, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Peak queued load and whether any queuing happened."""
    return (warehouse_load(load, wh=wh, as_of=as_of, days=days)
            .agg(F.max("avg_queued_queries").alias("peak_queued_queries"))
            .withColumn("queuing_detected", F.coalesce(F.col("peak_queued_queries") > 0, F.lit(False))))


def workload_costs(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, groups: DataFrame | None = None) -> DataFrame:
    """D3: credits, cost and query count per workload type."""
    price = param_value(params, default=P.PARAM_DEFAULTS[P.DOLLARS_PER_CREDIT])
    return (cost_by_workload_dash(qh, meter, wh=wh, as_of=as_of, days=days, groups=groups)
            .groupBy("workload_type")
            .agg(F.sum("total_credits").cast("double").alias("total_credits"),
                 F.sum("query_count").alias("query_count"))
            .withColumn("estimated_cost", F.round(F.col("total_credits") * price, 6)))


def path_costs(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, groups: DataFrame | None = None) -> DataFrame:
    """As D3 per model path, OTHER left out."""
    price = param_value(params, default=P.PARAM_DEFAULTS[P.DOLLARS_PER_CREDIT])
    return (cost_by_workload_dash(qh, meter, wh=wh, as_of=as_of, days=days, groups=groups)
            .filter(F.col("model_path") != P.PATH_DEFAULT)
            .groupBy("model_path")
            .agg(F.sum("total_credits").cast("double").alias("total_credits"),
                 F.sum("query_count").alias("query_count"))
            .withColumn("estimated_cost", F.round(F.col("total_credits") * price, 6)))


def cost_breakdown(qh, meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, groups: DataFrame | None = None) -> DataFrame:
    """The detailed table, renamed and rounded."""
    price = param_value(params, default=P.PARAM_DEFAULTS[P.DOLLARS_PER_CREDIT])
    c = cost_by_workload_dash(qh, meter, wh=wh, as_of=as_of, days=days, groups=groups)
    return c.select(F.col("workload_type").alias("workload"), "model_path",
                    F.col("query_count").alias("queries"),
                    F.round("total_credits", 4).cast("double").alias("credits"),
                    F.round(F.col("total_credits").cast("double") * price, 2).alias("cost_dollars"))


def spend_stats(meter, params, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Mean and peak daily cost over the window, and mean x 30."""
    price = param_value(params, default=P.PARAM_DEFAULTS[P.DOLLARS_PER_CREDIT])
    daily = (meter_window(meter, wh=wh, as_of=as_of, days=days)
             .groupBy(F.col("start_time").cast("date").alias("date"))
             .agg(F.sum("credits_used").alias("credits")))
    mean = F.sum("credits").cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))
    return (daily.agg(F.count(F.lit(1)).alias("days"), mean.alias("_m"),
                      F.max("credits").cast("double").alias("_p"))
            .select("days", F.round(F.col("_m") * price, 6).alias("avg_daily_cost"),
                    F.round(F.col("_p") * price, 6).alias("peak_daily_cost"),
                    F.round(F.col("_m") * price * 30, 6).alias("projected_monthly_cost")))


# --------------------------------------------------------------- D7 - D10 ---

def slowest_queries(qh, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, limit=10) -> DataFrame:
    """Ten slowest of the top-100 list, ties by query id."""
    return (query_performance(qh, wh=wh, as_of=as_of, days=days)
            .orderBy(F.col("execution_time_seconds").desc(), "query_id").limit(limit)
            .select("query_id", "execution_time_seconds", "workload_type"))


def workload_perf(qh, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, limit: int | None = None) -> DataFrame:
    """Mean / median / max seconds, GB and count per workload, over the window (or its ``limit`` slowest).

    The median is an exact order statistic by distributed selection, not a
    buffer of a workload's values; both sides of the join are one row per workload.
    """
    perf = query_performance(qh, wh=wh, as_of=as_of, days=days, limit=limit)
    middle = median(perf, ["workload_type"], "execution_time_seconds", "_median").select("workload_type", "_median")
    return (perf.groupBy("workload_type")
            .agg(F.round(F.avg("execution_time_seconds"), 2).alias("avg_time_s"),
                 F.round(F.max("execution_time_seconds"), 2).alias("max_time_s"),
                 F.round(F.sum("gb_scanned"), 2).alias("total_gb_scanned"),
                 F.count("query_id").alias("query_count"))
            .join(middle, "workload_type", "left")
            .select("workload_type", "avg_time_s", F.round("_median", 2).alias("median_time_s"), "max_time_s", "total_gb_scanned", "query_count"))


def runtime_histogram(qh, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, bins=P.HISTOGRAM_BINS,
                      limit: int | None = None) -> DataFrame:
    """Equal-width run-time bins (over min..max) per workload, over the window (or its ``limit`` slowest).

    The ends are one scalar sub-query with both figures, shared by every use.
    """
    perf = query_performance(qh, wh=wh, as_of=as_of, days=days, limit=limit)
    x = F.col("execution_time_seconds")
    ends = perf.select(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo = ends.getField("lo")
    width = (ends.getField("hi") - lo) / F.lit(bins)
    b = F.when(width > 0, F.least(F.floor((x - lo) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))).otherwise(0)
    return (perf.groupBy("workload_type", b.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("query_count"))
            .withColumn("bin_start", F.round(lo + F.col("bin") * width, 6))
            .withColumn("bin_end", F.round(lo + (F.col("bin") + 1) * width, 6)))


def queued_queries(qh, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, limit=10) -> DataFrame:
    """Queries of the window that queued: the slowest ten and the total count."""
    queued = query_performance(qh, wh=wh, as_of=as_of, days=days, limit=None).filter(F.col("queue_time_seconds") > 0)
    total = queued.select(F.count(F.lit(1))).scalar()
    return (queued.orderBy(F.col("execution_time_seconds").desc(), "query_id").limit(limit)
            .select("query_id", "workload_type", "execution_time_seconds", "queue_time_seconds",
                    total.alias("queued_count")))


# ---------------------------------------------------------------- D11 -------

def usage_hours(qh, meter, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, meter_days: int | None = None) -> DataFrame:
    """One row per (warehouse, hour) with query or metering figures: every log read once for all rules and bands.

    Query figures are of the last ``days``; metering figures of the last
    ``meter_days`` (``days`` if not given), with ``in_window`` rows, and seconds,
    of the last ``days``.  Hours cut by a window keep all their credits for
    attribution; ``trend_credits`` are those from the window's start on.
    """
    untagged = workload_type() == P.WORKLOAD_DEFAULT
    facts = (query_window(qh, wh=wh, as_of=as_of, days=days)
             .groupBy("warehouse_name", F.date_trunc("hour", "start_time").alias("_hour"))
             .agg(F.count(F.lit(1)).alias("queries"), F.count_if(untagged).alias("untagged_queries"),
                  F.count_if(F.col("total_elapsed_time") > P.SLOW_QUERY_SECONDS * 1000).alias("slow_queries"),
                  F.sum("total_elapsed_time").alias("elapsed_ms"), F.sum("queued_overload_time").alias("queued_ms")))
    inside = F.col("start_time") >= ntz(window_start(as_of, days))
    seconds = diff_units("second", "start_time", "end_time")
    hours = meter_hours(meter, wh=wh, as_of=as_of, days=max(days, meter_days or days), in_window=inside.cast("long"),
                        session_seconds=F.when(inside, seconds),
                        trend_credits=F.when(F.col("start_time") >= ntz(window_start(as_of, meter_days or days)), F.col("credits_used")))
    return facts.join(hours, ["warehouse_name", "_hour"], "full_outer")


def recommendation_metrics(qh, meter, load, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7,
                           utilisation_mode: str = "calendar") -> DataFrame:
    """One row with every figure the rules need, from one pass over each log.

    Utilisation: ``reference`` divides the hours with metering rows by
    themselves (always 100 when any row exists); ``calendar`` by the window's hours.
    """
    metered = F.count_distinct(F.when(F.col("in_window") > 0, F.col("_hour"))).cast("double")
    span = F.lit(float(days * 24)) if utilisation_mode == "calendar" else F.nullif(metered, F.lit(0.0))
    # A query row appears once per metering row of its hour, so credits are the hour's sum times its queries.
    untagged = F.sum(F.when(F.col("untagged_queries") > 0, F.col("untagged_queries") * F.col("_credits"))).cast("double")
    every = F.sum(F.col("queries") * F.col("_credits")).cast("double")
    peak = warehouse_load(load, wh=wh, as_of=as_of, days=days).select(F.max("avg_queued_queries")).scalar()
    return (usage_hours(qh, meter, wh=wh, as_of=as_of, days=days)
            .agg((F.lit(100.0) * metered / span).alias("utilisation_pct"), F.coalesce(F.sum("slow_queries"), F.lit(0)).alias("slow_queries"),
                 untagged.alias("untagged_credits"), (F.lit(100.0) * untagged / F.nullif(every, F.lit(0.0))).alias("untagged_pct"))
            .withColumn("max_queued", peak))


def _fmt1(c: Column) -> Column:
    return F.format_string("%.1f", F.round(c, 1))


def recommendations(qh, meter, load, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7,
                    utilisation_mode: str = "calendar") -> DataFrame:
    """The four rules, each with the step to take; fired ones only, ordered by priority."""
    m = recommendation_metrics(qh, meter, load, wh=wh, as_of=as_of, days=days, utilisation_mode=utilisation_mode)
    rank = dict(P.PRIORITY_RANK)

    def rule(fired, priority, category, issue, advice, action):
        return F.struct(fired.alias("fired"), F.lit(priority).alias("priority"), F.lit(category).alias("category"),
                        issue.alias("issue"), advice.alias("recommendation"), F.lit(P.ACTIONS[action]).alias("action"),
                        F.lit(rank[priority]).alias("priority_rank"))

    rules = F.array(
        rule(F.col("max_queued") > P.QUEUE_PEAK_HIGH, "HIGH", "Performance",
             F.lit("Queries are queuing"),
             F.concat(F.lit("Peak queued load "), _fmt1(F.col("max_queued")),
                      F.lit("; use a larger warehouse or more clusters.")), "queued"),
        rule(F.col("utilisation_pct") < P.LOW_UTILISATION_PCT, "MEDIUM", "Cost",
             F.concat(F.lit("Utilisation is low ("), _fmt1(F.col("utilisation_pct")), F.lit("%)")),
             F.lit("Shorten auto-suspend or consolidate workloads."), "idle"),
        rule(F.col("slow_queries") > 0, "MEDIUM", "Performance",
             F.concat(F.col("slow_queries").cast("string"), F.lit(" queries ran longer than "),
                      F.lit(str(P.SLOW_QUERY_SECONDS)), F.lit(" s")),
             F.lit("Review their plans; consider clustering or materialised results."), "slow"),
        rule(F.col("untagged_credits") > 0, "LOW", "Monitoring",
             F.concat(_fmt1(F.col("untagged_pct")), F.lit("% of credits are untagged")),
             F.lit("Tag every workload as WORKLOAD:<type>|PATH:<path>."), "untagged"),
    )
    return (m.select(F.explode(rules).alias("r")).select("r.*")
            .filter(F.coalesce(F.col("fired"), F.lit(False))).drop("fired")
            .orderBy("priority_rank", "category", "issue"))


# ---------------------------------------------------------------- D12 -------

def _band(value: Column, ok_below: float, act_above: float | None = None) -> Column:
    if act_above is None:
        return F.when(value.isNull(), F.lit(None)).when(value < ok_below, "OK").otherwise("ACT")
    return (F.when(value.isNull(), F.lit(None)).when(value < ok_below, "OK")
            .when(value <= act_above, "WATCH").otherwise("ACT"))


def kpi_status(qh, meter, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7, trend_days=30) -> DataFrame:
    """KPI values against the monitoring guide's bands, from one pass over each log.

    daily variance = largest day-over-day change of daily credits (percent,
    over ``trend_days``); untagged share of queries, queue and idle shares and
    calendar utilisation over ``days``.  Hours become days (``trend_days`` rows,
    over which the lag runs), and days one row.  ``value_by_credits`` is the
    untagged share of the attributed credits, null for other figures; the bands
    are for the share of queries.
    """
    sums = ("queries", "untagged_queries", "elapsed_ms", "queued_ms", "session_seconds")
    daily = (usage_hours(qh, meter, wh=wh, as_of=as_of, days=days, meter_days=trend_days)
             .groupBy(F.col("_hour").cast("date").alias("date"))
             .agg(F.sum("trend_credits").cast("double").alias("credits"),
                  F.count_distinct(F.when(F.col("in_window") > 0, F.col("_hour"))).alias("hours"),
                  # A query row appears once per metering row of its hour, as in recommendation_metrics.
                  F.sum(F.col("untagged_queries") * F.col("_credits")).alias("untagged_credits"),
                  F.sum(F.col("queries") * F.col("_credits")).alias("query_credits"), *(F.sum(c).alias(c) for c in sums)))
    prev = F.lag("credits").over(Window.orderBy("date"))
    m = (daily.withColumn("change", F.lit(100.0) * F.abs(F.col("credits") - prev) / F.nullif(prev, F.lit(0.0)))
         .agg(F.max("change").alias("variance"), F.sum("hours").cast("double").alias("hours"),
              *(F.sum(c).cast("double").alias(c) for c in ("untagged_credits", "query_credits")), *(F.sum(c).alias(c) for c in sums)))
    variance = F.col("variance")
    untagged = F.lit(100.0) * F.col("untagged_queries") / F.nullif(F.col("queries"), F.lit(0))
    by_credits = F.lit(100.0) * F.col("untagged_credits") / F.nullif(F.col("query_credits"), F.lit(0.0))
    none = F.lit(None).cast("double").alias("value_by_credits")
    queue = F.lit(100.0) * F.col("queued_ms") / F.nullif(F.col("elapsed_ms"), F.lit(0))
    session_h = F.col("session_seconds") / F.lit(3600.0)
    idle = F.lit(100.0) * (session_h - F.col("elapsed_ms") / F.lit(1000.0) / F.lit(3600.0)) / F.nullif(session_h, F.lit(0.0))
    util = F.lit(100.0) * F.col("hours") / F.lit(float(days * 24))
    lo, hi = P.UTILISATION_BAND
    return (m.select(F.explode(F.array(
        F.struct(F.lit("daily_cost_variance_pct").alias("kpi"), F.round(variance, 2).alias("value"),
                 _band(variance, P.DAILY_VARIANCE_OK_PCT, P.DAILY_VARIANCE_ACT_PCT).alias("status"), none),
        F.struct(F.lit("untagged_pct").alias("kpi"), F.round(untagged, 2).alias("value"),
                 _band(untagged, P.UNTAGGED_OK_PCT).alias("status"), F.round(by_credits, 2).alias("value_by_credits")),
        F.struct(F.lit("queue_pct").alias("kpi"), F.round(queue, 2).alias("value"),
                 _band(queue, P.QUEUE_OK_PCT, P.QUEUE_ACT_PCT).alias("status"), none),
        F.struct(F.lit("idle_pct").alias("kpi"), F.round(idle, 2).alias("value"),
                 _band(idle, P.IDLE_OK_PCT).alias("status"), none),
        F.struct(F.lit("utilisation_pct").alias("kpi"), F.round(util, 2).alias("value"),
                 F.when(util.isNull(), F.lit(None)).when(util < lo, "LOW").when(util <= hi, "OK")
                 .otherwise("HIGH").alias("status"), none),
    )).alias("k")).select("k.*"))


def kpi_trends(qh, meter, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """D12, the guide's trends: each figure of the last ``days`` against the ``days`` before them.

    change_pct is null without an earlier figure.  A cost per run that doubled
    or a query time that grew by half is ACT; any other growth of a figure that
    should not grow is WATCH; queued queries are WATCH where there are any.
    """
    recent = F.col("start_time") >= ntz(window_start(as_of, days))
    groups = attributed_groups(qh, meter, {"workload_type": workload_type(), "recent": recent}, distinct=False, wh=wh, as_of=as_of,
                               days=2 * days, q=F.lit(1), own_ms=F.col("total_elapsed_time"), read_bytes=F.col("bytes_scanned"),
                               queued=(F.col("queued_overload_time") > 0).cast("long"))

    def total(column: str, now: bool, workload: str | None) -> Column:
        chosen = F.col("recent") if now else ~F.col("recent")
        return F.sum(F.when(chosen if workload is None else chosen & (F.col("workload_type") == workload), F.col(column))).cast("double")

    def ratio(a: str, b: str, scale: float = 1.0, workload: str | None = None) -> list[Column]:
        return [total(a, now, workload) / F.nullif(total(b, now, workload) * scale, F.lit(0.0)) for now in (True, False)]

    figures = {"training_credits_per_run": ratio("credits", "rows", workload="TRAINING"),
               "inference_credits_per_run": ratio("credits", "rows", workload="INFERENCE"),
               "avg_query_seconds": ratio("own_ms", "q", 1000.0), "credits_per_execution": ratio("credits", "rows"),
               "gb_scanned_per_query": ratio("read_bytes", "q", 1073741824.0),
               "queued_queries": [total("queued", now, None) for now in (True, False)]}
    row = groups.agg(*(c.alias(f"{n}_{when}") for n, pair in figures.items() for c, when in zip(pair, ("now", "before"))))

    def entry(name: str) -> Column:
        now, before = F.col(f"{name}_now"), F.col(f"{name}_before")
        change = F.lit(100.0) * (now - before) / F.nullif(before, F.lit(0.0))
        acts = P.TREND_ACT_PCT.get(name)
        grown = F.when(change.isNull(), F.lit(None))
        grown = (grown if acts is None else grown.when(change >= acts, "ACT")).when(change > 0, "WATCH").otherwise("OK")
        status = F.when(now > 0, "WATCH").otherwise("OK") if name == "queued_queries" else grown
        return F.struct(F.lit(name).alias("kpi"), F.round(now, 6).alias("current"), F.round(before, 6).alias("previous"),
                        F.round(change, 2).alias("change_pct"), status.alias("status"))

    return row.select(F.explode(F.array(*map(entry, figures))).alias("k")).select("k.*")
