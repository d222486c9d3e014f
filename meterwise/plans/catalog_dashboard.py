"""Registered dashboard, budget and cost-estimation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.operators import budget as B
from meterwise.operators import costs as C
from meterwise.operators import dashboard as D
from meterwise.plans import oracle as O
from meterwise.plans.catalog import QUERY_PERFORMANCE_SQL, QUERY_WINDOW_SQL, _billing_since, logs, register
from meterwise.plans.oracle import WH, since, with_ctes
from meterwise.sources.logs import usage_logs

PRICE_D = f"coalesce({O.PRICE}, 3.0::double)"
WL = O.workload_case()
MP = O.path_case()


def _att(days: int) -> str:
    return f"SELECT *, {WL} AS workload_type, {MP} AS model_path FROM attributed WHERE start_time >= {since(days)}"


def _mwin(days: int) -> str:
    return f"SELECT * FROM mh WHERE warehouse_name = {WH} AND start_time >= {since(days)}"


def _qwin(days: int) -> str:
    return (f"SELECT * FROM qh WHERE warehouse_name = {WH} AND start_time >= {since(days)} "
            f"AND execution_status = 'SUCCESS'")


DASH_COST = f"""SELECT workload_type, model_path, count(DISTINCT query_id) AS query_count,
  sum(credits_used) AS total_credits FROM ({_att(7)}) a GROUP BY workload_type, model_path"""


register("dashboard_kpis", "D1", with_ctes(f"""
SELECT total_credits, round(total_credits * {PRICE_D}, 6) AS total_cost, total_executions,
  round(a, 6) AS avg_credits_per_hour
FROM (SELECT cast(sum(credits_used) AS double) AS total_credits, count(*) AS total_executions,
        cast(sum(credits_used) AS double) / nullif(count(DISTINCT date_trunc('hour', start_time)), 0) AS a
      FROM ({_mwin(7)}) m) k""", "mh", "params"))(
    logs(7, lambda L: D.dashboard_kpis(L.meter, L.params)))

register("queue_alert", "D2", with_ctes(f"""
SELECT max(avg_queued_load) AS peak_queued_queries, coalesce(max(avg_queued_load) > 0, false) AS queuing_detected
FROM lh WHERE warehouse_name = {WH} AND start_time >= {since(7)}""", "lh"))(
    logs(7, lambda L: D.queue_alert(L.load)))

register("workload_costs", "D3", with_ctes(f"""
SELECT workload_type, cast(sum(total_credits) AS double) AS total_credits, cast(sum(query_count) AS bigint) AS query_count,
  round(cast(sum(total_credits) AS double) * {PRICE_D}, 6) AS estimated_cost
FROM dash GROUP BY workload_type""", "attributed", "params", extra={"dash": DASH_COST}))(
    logs(7, lambda L: D.workload_costs(L.qh, L.meter, L.params)))

register("path_costs", "D4", with_ctes(f"""
SELECT model_path, cast(sum(total_credits) AS double) AS total_credits, cast(sum(query_count) AS bigint) AS query_count,
  round(cast(sum(total_credits) AS double) * {PRICE_D}, 6) AS estimated_cost
FROM dash WHERE model_path != 'OTHER' GROUP BY model_path""", "attributed", "params", extra={"dash": DASH_COST}))(
    logs(7, lambda L: D.path_costs(L.qh, L.meter, L.params)))

register("cost_breakdown", "D5", with_ctes(f"""
SELECT workload_type AS workload, model_path, query_count AS queries,
  cast(round(total_credits, 4) AS double) AS credits,
  round(cast(total_credits AS double) * {PRICE_D}, 2) AS cost_dollars
FROM dash""", "attributed", "params", extra={"dash": DASH_COST}))(
    logs(7, lambda L: D.cost_breakdown(L.qh, L.meter, L.params)))

register("spend_stats", "D6", with_ctes(f"""
SELECT count(*) AS days,
  round(cast(sum(credits) AS double) / nullif(count(*), 0) * {PRICE_D}, 6) AS avg_daily_cost,
  round(cast(max(credits) AS double) * {PRICE_D}, 6) AS peak_daily_cost,
  round(cast(sum(credits) AS double) / nullif(count(*), 0) * {PRICE_D} * 30, 6) AS projected_monthly_cost
FROM (SELECT cast(start_time AS date) AS date, sum(credits_used) AS credits FROM ({_mwin(30)}) m GROUP BY 1) d""",
    "mh", "params"))(
    logs(30, lambda L: D.spend_stats(L.meter, L.params, days=30)))

register("slowest_queries", "D7", with_ctes("""
SELECT query_id, execution_time_seconds, workload_type FROM qp
ORDER BY execution_time_seconds DESC, query_id LIMIT 10""", "qh", extra={"qp": QUERY_PERFORMANCE_SQL}))(
    logs(7, lambda L: D.slowest_queries(L.qh)))

register("workload_perf", "D8", with_ctes("""
SELECT workload_type, round(avg(execution_time_seconds), 2) AS avg_time_s,
  round(median(execution_time_seconds), 2) AS median_time_s, round(max(execution_time_seconds), 2) AS max_time_s,
  round(sum(gb_scanned), 2) AS total_gb_scanned, count(query_id) AS query_count
FROM qp GROUP BY workload_type""", "qh", extra={"qp": QUERY_WINDOW_SQL}))(
    logs(7, lambda L: D.workload_perf(L.qh)))

register("runtime_histogram", "D9", with_ctes(f"""
SELECT workload_type, bin, count(*) AS query_count, round(lo + bin * w, 6) AS bin_start,
  round(lo + (bin + 1) * w, 6) AS bin_end
FROM (SELECT q.workload_type, lo, (hi - lo) / {P.HISTOGRAM_BINS} AS w,
        cast(CASE WHEN (hi - lo) / {P.HISTOGRAM_BINS} > 0
             THEN least(floor((q.execution_time_seconds - lo) / nullif((hi - lo) / {P.HISTOGRAM_BINS}, 0)),
                        {P.HISTOGRAM_BINS - 1})
             ELSE 0 END AS int) AS bin
      FROM qp q, (SELECT min(execution_time_seconds) AS lo, max(execution_time_seconds) AS hi FROM qp) mm) b
GROUP BY workload_type, bin, lo, w""", "qh", extra={"qp": QUERY_WINDOW_SQL}))(
    logs(7, lambda L: D.runtime_histogram(L.qh)))

register("queued_queries", "D10", with_ctes("""
SELECT query_id, workload_type, execution_time_seconds, queue_time_seconds,
  (SELECT count(*) FROM qp WHERE queue_time_seconds > 0) AS queued_count
FROM qp WHERE queue_time_seconds > 0 ORDER BY execution_time_seconds DESC, query_id LIMIT 10""", "qh",
    extra={"qp": QUERY_WINDOW_SQL}))(logs(7, lambda L: D.queued_queries(L.qh)))

_FMT = "printf('%.1f', round({x}, 1))"
register("recommendations", "D11", with_ctes(f"""
SELECT priority, category, issue, recommendation, action, priority_rank FROM (
  SELECT max_queued > {P.QUEUE_PEAK_HIGH} AS fired, 'HIGH' AS priority, 'Performance' AS category,
    'Queries are queuing' AS issue,
    'Peak queued load ' || {_FMT.format(x='max_queued')} || '; use a larger warehouse or more clusters.' AS recommendation,
    '{P.ACTIONS["queued"]}' AS action,
    0 AS priority_rank FROM metrics
  UNION ALL SELECT utilisation_pct < {P.LOW_UTILISATION_PCT}, 'MEDIUM', 'Cost',
    'Utilisation is low (' || {_FMT.format(x='utilisation_pct')} || '%)',
    'Shorten auto-suspend or consolidate workloads.', '{P.ACTIONS["idle"]}', 1 FROM metrics
  UNION ALL SELECT slow_queries > 0, 'MEDIUM', 'Performance',
    cast(slow_queries AS varchar) || ' queries ran longer than {P.SLOW_QUERY_SECONDS} s',
    'Review their plans; consider clustering or materialised results.', '{P.ACTIONS["slow"]}', 1 FROM metrics
  UNION ALL SELECT untagged_credits > 0, 'LOW', 'Monitoring',
    {_FMT.format(x='untagged_pct')} || '% of credits are untagged',
    'Tag every workload as WORKLOAD:<type>|PATH:<path>.', '{P.ACTIONS["untagged"].replace("'", "''")}', 2 FROM metrics
) r WHERE coalesce(fired, false)""", "attributed", "lh", extra={
    "qp": QUERY_WINDOW_SQL,
    "dash": DASH_COST,
    "metrics": f"""
SELECT (SELECT max(avg_queued_load) FROM lh WHERE warehouse_name = {WH} AND start_time >= {since(7)}) AS max_queued,
  (SELECT 100.0::double * count(DISTINCT date_trunc('hour', start_time)) / {7 * 24}.0::double FROM ({_mwin(7)}) m)
    AS utilisation_pct,
  (SELECT count(*) FILTER (WHERE execution_time_seconds > {P.SLOW_QUERY_SECONDS}) FROM qp) AS slow_queries,
  (SELECT cast(sum(CASE WHEN workload_type = 'UNTAGGED' THEN total_credits END) AS double) FROM dash) AS untagged_credits,
  (SELECT 100.0::double * cast(sum(CASE WHEN workload_type = 'UNTAGGED' THEN total_credits END) AS double)
          / nullif(cast(sum(total_credits) AS double), 0) FROM dash) AS untagged_pct"""}))(
    logs(7, lambda L: D.recommendations(L.qh, L.meter, L.load)))

register("kpi_status", "D12", with_ctes(f"""
SELECT 'daily_cost_variance_pct' AS kpi, round(variance, 2) AS value,
  CASE WHEN variance IS NULL THEN NULL WHEN variance < {P.DAILY_VARIANCE_OK_PCT} THEN 'OK'
       WHEN variance <= {P.DAILY_VARIANCE_ACT_PCT} THEN 'WATCH' ELSE 'ACT' END AS status,
  cast(NULL AS double) AS value_by_credits FROM k
UNION ALL SELECT 'untagged_pct', round(untagged, 2),
  CASE WHEN untagged IS NULL THEN NULL WHEN untagged < {P.UNTAGGED_OK_PCT} THEN 'OK' ELSE 'ACT' END, round(untagged_credits, 2) FROM k
UNION ALL SELECT 'queue_pct', round(queue, 2),
  CASE WHEN queue IS NULL THEN NULL WHEN queue < {P.QUEUE_OK_PCT} THEN 'OK'
       WHEN queue <= {P.QUEUE_ACT_PCT} THEN 'WATCH' ELSE 'ACT' END, NULL FROM k
UNION ALL SELECT 'idle_pct', round(idle, 2),
  CASE WHEN idle IS NULL THEN NULL WHEN idle < {P.IDLE_OK_PCT} THEN 'OK' ELSE 'ACT' END, NULL FROM k
UNION ALL SELECT 'utilisation_pct', round(util, 2),
  CASE WHEN util IS NULL THEN NULL WHEN util < {P.UTILISATION_BAND[0]} THEN 'LOW'
       WHEN util <= {P.UTILISATION_BAND[1]} THEN 'OK' ELSE 'HIGH' END, NULL FROM k""", "attributed", "mh", extra={
    "k": f"""
SELECT
  (SELECT max(100.0::double * abs(credits - prev) / nullif(prev, 0)) FROM (
     SELECT credits, lag(credits) OVER (ORDER BY date) AS prev FROM (
       SELECT cast(start_time AS date) AS date, cast(sum(credits_used) AS double) AS credits
       FROM ({_mwin(30)}) m GROUP BY 1) d) v) AS variance,
  (SELECT 100.0::double * count(*) FILTER (WHERE {WL} = 'UNTAGGED') / nullif(count(*), 0) FROM ({_qwin(7)}) q) AS untagged,
  (SELECT 100.0::double * cast(sum(CASE WHEN workload_type = 'UNTAGGED' THEN credits_used ELSE 0 * credits_used END) AS double)
          / nullif(cast(sum(credits_used) AS double), 0) FROM ({_att(7)}) a) AS untagged_credits,
  (SELECT 100.0::double * cast(sum(queued_overload_time) AS double) / nullif(cast(sum(total_elapsed_time) AS double), 0)
     FROM ({_qwin(7)}) q) AS queue,
  (SELECT 100.0::double * (s - a) / nullif(s, 0) FROM
     (SELECT sum({O.diff_units('second', 'start_time', 'end_time')}) / 3600.0::double AS s FROM ({_mwin(7)}) m) ss,
     (SELECT sum(total_elapsed_time) / 1000.0::double / 3600.0::double AS a FROM ({_qwin(7)}) q) aa) AS idle,
  (SELECT 100.0::double * count(DISTINCT date_trunc('hour', start_time)) / {7 * 24}.0::double
     FROM ({_mwin(7)}) m) AS util"""}))(
    logs(30, lambda L: D.kpi_status(L.qh, L.meter)))

def _per(a: str, b: str, more: str = "") -> str:
    return f"cast({a} FILTER (WHERE {{w}}{more}) AS double) / nullif({b.format(f='FILTER (WHERE {w}' + more + ')')}, 0)"


_TREND_RATIOS = {"training_credits_per_run": _per("sum(credits_used)", "count(*) {f}", " AND workload_type = 'TRAINING'"),
                 "inference_credits_per_run": _per("sum(credits_used)", "count(*) {f}", " AND workload_type = 'INFERENCE'"),
                 "avg_query_seconds": _per("sum(total_elapsed_time)", "count(*) {f} * 1000.0::double"),
                 "credits_per_execution": _per("sum(credits_used)", "count(*) {f}"),
                 "gb_scanned_per_query": _per("sum(bytes_scanned)", "count(*) {f} * 1073741824.0::double"),
                 "queued_queries": "count(*) FILTER (WHERE {w} AND queued_overload_time > 0)"}


def _trend(name: str, expr: str) -> str:
    now, before = (expr.format(w=w) for w in ("recent", "NOT recent"))
    acts = P.TREND_ACT_PCT.get(name, 10 ** 9)
    status = ("CASE WHEN c > 0 THEN 'WATCH' ELSE 'OK' END" if name == "queued_queries" else
              f"CASE WHEN ch IS NULL THEN NULL WHEN ch >= {acts} THEN 'ACT' WHEN ch > 0 THEN 'WATCH' ELSE 'OK' END")
    return (f"SELECT '{name}' AS kpi, round(c, 6) AS current, round(b, 6) AS previous, round(ch, 2) AS change_pct, {status} AS status "
            f"FROM (SELECT c, b, 100.0::double * (c - b) / nullif(b, 0) AS ch FROM (SELECT cast({now} AS double) AS c, cast({before} AS double) AS b FROM a) x) y")


register("kpi_trends", "D12 (trends)", with_ctes("\nUNION ALL ".join(_trend(n, e) for n, e in _TREND_RATIOS.items()), "attributed", extra={
    "a": f"SELECT *, {WL} AS workload_type, start_time >= {since(7)} AS recent FROM attributed WHERE start_time >= {since(14)}"}))(
    logs(14, lambda L: D.kpi_trends(L.qh, L.meter)))

# ---------------------------------------------------------------- budgets ---

register("budget_status", "M1", with_ctes(f"""
SELECT '{P.BUDGET_NAME}' AS monitor_name, {P.MONTHLY_QUOTA}::double AS credit_quota, used AS used_credits,
  {P.MONTHLY_QUOTA}::double - used AS remaining_credits, round(100.0::double * used / {P.MONTHLY_QUOTA}::double, 2) AS percent_used,
  'MONTHLY' AS frequency, TIMESTAMP '2024-01-01 00:00:00' AS start_time, TIMESTAMP '2024-02-01 00:00:00' AS end_time
FROM (SELECT coalesce(cast(sum(credits_used) AS double), 0.0::double) AS used FROM mh
      WHERE warehouse_name = {WH} AND start_time >= TIMESTAMP '2024-01-01 00:00:00'
        AND start_time < TIMESTAMP '2024-02-01 00:00:00') u""", "mh"))(
    logs(None, lambda L: B.budget_status(L.meter), start=P.AS_OF.replace(day=1, hour=0, minute=0, second=0, microsecond=0)))

_CROSS = "\nUNION ALL ".join(
    f"SELECT '{P.BUDGET_NAME}' AS resource_monitor_name, {t} AS threshold, '{a}' AS trigger_type, t{t} AS trigger_time "
    f"FROM c WHERE t{t} IS NOT NULL" for t, a in P.BUDGET_THRESHOLDS)
_MINS = ", ".join(f"min(CASE WHEN cast(running AS double) >= {t * P.MONTHLY_QUOTA / 100.0} THEN start_time END) AS t{t}"
                  for t, _ in P.BUDGET_THRESHOLDS)
register("budget_crossings", "M2", with_ctes(_CROSS, "mh", extra={
    "r": f"""SELECT date_trunc('month', start_time) AS m, start_time,
  sum(credits_used) OVER (PARTITION BY date_trunc('month', start_time) ORDER BY start_time
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
FROM mh WHERE warehouse_name = {WH}""",
    "c": f"SELECT m, {_MINS} FROM r GROUP BY m"}))(
    logs(None, lambda L: B.budget_crossings(L.meter)))

# ------------------------------------------------------------------ costs ---

_HOURS = f"(SELECT sum({O.diff_units('minute', 'start_time', 'end_time')}) / 60.0::double FROM ({_mwin(7)}) m)"
_LADDER = ", ".join(f"('{s}', {r}::double)" for s, r, _ in P.SIZE_SCENARIOS)
register("estimate_scenarios", "C1 C2", with_ctes(f"""
SELECT size, runtime_hours, credits_per_hour, round(runtime_hours * credits_per_hour, 6) AS estimated_credits,
  round(runtime_hours * credits_per_hour * {O.PRICE}, 6) AS estimated_dollars
FROM (SELECT size, credits_per_hour, round({_HOURS}, 6) AS runtime_hours
      FROM (VALUES {_LADDER}) AS t(size, credits_per_hour)) s""", "mh", "params"))(
    logs(7, lambda L: C.estimate_scenarios(L.meter, L.params)))

_JOBS = "\nUNION ALL ".join(f"SELECT '{n}' AS scenario, {h}::double AS planned_hours, {o} AS observed_hours" for (n, h), o in zip(P.JOB_SCENARIOS, (
    "(SELECT avg(total_elapsed_time) / 3600000.0::double FROM q WHERE query_tag LIKE '%WORKLOAD:TRAINING%')",
    "(SELECT 30.0::double * sum(total_elapsed_time) / 3600000.0::double / nullif(count(DISTINCT cast(start_time AS date)), 0) "
    "FROM q WHERE query_tag LIKE '%WORKLOAD:INFERENCE%')")))
register("job_scenarios", "C1 C2 A13 A14", with_ctes(f"""
SELECT scenario, planned_hours, round(planned_hours * rate, 6) AS planned_credits, round(planned_hours * rate * price, 6) AS planned_dollars,
  round(observed_hours, 6) AS observed_hours, round(observed_hours * rate, 6) AS observed_credits,
  round(observed_hours * rate * price, 6) AS observed_dollars
FROM jobs, (SELECT (SELECT max(param_value) FROM params WHERE param_name = '{P.MEDIUM_CREDITS_PER_HOUR}') AS rate, {O.PRICE} AS price) p""",
    "qh", "params", extra={"q": _qwin(30), "jobs": _JOBS}))(logs(30, lambda L: C.job_scenarios(L.qh, L.params)))


def _preflight(spark, d):
    week, history = usage_logs(spark, d, 7), usage_logs(spark, d, since=_billing_since())   # billing spans months
    return C.preflight_estimate(week.qh, week.meter, history.billing, week.params)


def _refresh_params(spark, d):
    week, history = usage_logs(spark, d, 7), usage_logs(spark, d, since=_billing_since())
    return (C.refresh_cost_params(week.params, week.meter, history.billing)
            .withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")))


_RUNTIME = (f"(SELECT avg({O.diff_units('minute', 'start_time', 'end_time')}) / 60.0::double FROM qh "
            f"WHERE start_time >= {since(7)} AND query_text ILIKE '%job_purchase%')")
_RATE = (f"(SELECT cast(sum(credits_used) AS double) / nullif(sum({O.diff_units('minute', 'start_time', 'end_time')}) / 60, 0) "
         f"FROM ({_mwin(7)}) m)")
_BILLED = (f"(SELECT round(cast(sum(amount_due) AS double) / nullif(cast(sum(credits_used) AS double), 0), 4) "
           f"FROM billing WHERE statement_date >= {O.AS_OF_DATE} - INTERVAL 3 MONTH)")
_LARGE = f"(SELECT max(param_value) FROM params WHERE param_name = '{P.LARGE_CREDITS_PER_HOUR}')"
register("preflight_estimate", "C1 C3 A19 A20 A21", with_ctes(f"""
SELECT round(h, 6) AS runtime_hours, round(r, 6) AS credits_per_hour, p AS dollars_per_credit,
  round(h * r, 6) AS estimated_credits, round(h * r * p, 6) AS estimated_dollars,
  round(h * l, 6) AS large_estimated_credits, round(h * l * {O.PRICE}, 6) AS large_estimated_dollars
FROM (SELECT {_RUNTIME} AS h, {_RATE} AS r, {_BILLED} AS p, {_LARGE} AS l) x""", "qh", "mh", "billing", "params"))(
    _preflight)

_RATE6 = f"round({_RATE}, 6)"
register("refresh_cost_params", "S9", with_ctes(f"""
SELECT coalesce(s.param_name, t.param_name) AS param_name,
  CASE WHEN s.param_name IS NOT NULL THEN s.param_value ELSE t.param_value END AS param_value,
  CASE WHEN s.param_name IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00'
       ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
FROM params t FULL OUTER JOIN (
  SELECT 'DOLLARS_PER_CREDIT' AS param_name, {_BILLED} AS param_value
  UNION ALL SELECT 'OBSERVED_CREDITS_PER_HOUR', {_RATE6}) s ON t.param_name = s.param_name""",
    "mh", "billing", "params"))(
    _refresh_params)
