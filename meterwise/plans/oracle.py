"""DuckDB oracle SQL: the fixture views as CTEs plus shared expressions.

Only the driver's tables are registered on the DuckDB side, so every oracle
query inlines the views it needs.  ``with_ctes(body, *names)`` adds the named
views and everything they depend on, in dependency order.
"""

from __future__ import annotations

from meterwise import params as P

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_DATE = "DATE '2024-01-31'"
WH = f"'{P.WAREHOUSE}'"


def since(days: int) -> str:
    return f"{AS_OF} - INTERVAL {days} DAY"


def case_classify(col: str, prefix: str, classes, default: str | None) -> str:
    whens = " ".join(f"WHEN {col} LIKE '%{prefix}:{c}%' THEN '{c}'" for c in classes)
    dflt = "NULL" if default is None else f"'{default}'"
    return f"CASE {whens} ELSE {dflt} END"


def workload_case(col: str = "query_tag", classes=P.WORKLOAD_CLASSES, default=P.WORKLOAD_DEFAULT) -> str:
    return case_classify(col, "WORKLOAD", classes, default)


def path_case(col: str = "query_tag", classes=P.PATH_CLASSES, default=P.PATH_DEFAULT) -> str:
    return case_classify(col, "PATH", classes, default)


def tag_field(col: str, key: str) -> str:
    return f"nullif(regexp_extract({col}, '(?:^|\\|){key}:([^|]*)', 1), '')"


PRICE = f"(SELECT max(param_value) FROM params WHERE param_name = '{P.DOLLARS_PER_CREDIT}')"


def diff_units(unit: str, a: str, b: str) -> str:
    return f"date_diff('{unit}', {a}, {b})"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "qh": ((), """
SELECT q.*, start_time + to_milliseconds(total_elapsed_time) AS end_time FROM (
  SELECT event_id AS query_id, concat('user_', cast(user_id AS varchar)) AS user_name,
    CASE WHEN user_id % 4 = 0 THEN 'AUX_WH' ELSE 'FORECAST_WH' END AS warehouse_name,
    ts AS start_time, cast(round(value * 1000) AS bigint) AS total_elapsed_time,
    CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status,
    CASE event_type
      WHEN 'purchase' THEN concat('WORKLOAD:TRAINING|PATH:', CASE WHEN k % 2 = 0 THEN 'NATIVE' ELSE 'BOOSTED' END)
      WHEN 'view' THEN concat('WORKLOAD:INFERENCE|PATH:', CASE WHEN k % 2 = 0 THEN 'NATIVE' ELSE 'BOOSTED' END,
                              CASE WHEN k % 3 = 0 THEN '|SCHEDULED:TRUE' ELSE '' END)
      WHEN 'click' THEN 'WORKLOAD:DATA_PREP'
      WHEN 'error' THEN 'WORKLOAD:INFERENCE' END AS query_tag,
    concat('CALL job_', event_type, '(', cast(k AS varchar), ')') AS query_text,
    cast(CASE WHEN k % 5 = 0 THEN k * 10 ELSE 0 END AS bigint) AS queued_overload_time,
    cast((k % 7) * 100 AS bigint) AS queued_provisioning_time, cast(0 AS bigint) AS queued_repair_time,
    cast(k AS bigint) * 1048576 AS bytes_scanned, cast(k AS bigint) * 10 AS rows_produced
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS int) AS k FROM events) e) q"""),
    "mh": (("qh",), """
SELECT warehouse_name, min(start_time) AS start_time, max(start_time) + INTERVAL 30 MINUTES AS end_time,
  cast(round(sum(total_elapsed_time) * 6 / cast(3600000 AS double), 6) AS decimal(18,6)) AS credits_used
FROM qh GROUP BY warehouse_name, date_trunc('hour', start_time)"""),
    "lh": (("qh",), """
SELECT warehouse_name, date_trunc('hour', start_time) AS start_time,
  date_trunc('hour', start_time) + INTERVAL 1 HOUR AS end_time,
  sum(total_elapsed_time) / cast(3600000 AS double) AS avg_running,
  sum(queued_overload_time) / cast(3600000 AS double) AS avg_queued_load,
  sum(queued_provisioning_time) / cast(3600000 AS double) AS avg_queued_provisioning,
  sum(CASE WHEN execution_status = 'FAIL' THEN 1 ELSE 0 END) / cast(60 AS double) AS avg_blocked
FROM qh GROUP BY warehouse_name, date_trunc('hour', start_time)"""),
    "billing": (("mh",), """
SELECT cast(start_time AS date) AS statement_date, sum(credits_used) AS credits_used,
  cast(round(cast(sum(credits_used) AS double) * 3, 2) AS decimal(18,2)) AS amount_due
FROM mh GROUP BY cast(start_time AS date)"""),
    "params": ((), """
SELECT * FROM (VALUES ('DOLLARS_PER_CREDIT', cast(3.0 AS double)),
  ('SP_WH_MEDIUM_CREDITS_PER_HOUR', cast(6.0 AS double))) AS t(param_name, param_value)"""),
    "weekly_by_region": ((), """
SELECT r_name AS region, p_brand AS isrc, concat('Artist ', p_brand) AS display_artist,
  concat('Track ', p_brand) AS track, DATE '1995-01-01' - 7 * cast(substr(p_brand, 7) AS int) AS release_date,
  cast(date_trunc('week', l_shipdate + INTERVAL 1 DAY) AS date) + 5 AS week_ending,
  cast(sum(l_quantity) AS bigint) AS streams
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, p_brand, cast(date_trunc('week', l_shipdate + INTERVAL 1 DAY) AS date) + 5"""),
    "weekly_input": (("weekly_by_region",), """
SELECT * FROM weekly_by_region UNION ALL
SELECT 'Global' AS region, isrc, display_artist, track, release_date, week_ending,
  cast(sum(streams) AS bigint) AS streams
FROM weekly_by_region GROUP BY isrc, display_artist, track, release_date, week_ending"""),
    # J1 without a time bound; reports add their own window.
    "attributed": (("qh", "mh"), f"""
SELECT qh.*, wmh.credits_used
FROM qh LEFT JOIN mh wmh
  ON qh.warehouse_name = wmh.warehouse_name
 AND date_trunc('hour', qh.start_time) = date_trunc('hour', wmh.start_time)
WHERE qh.warehouse_name = {WH} AND qh.execution_status = 'SUCCESS'"""),
}


def _resolve(names) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the named fixture views (and their dependencies).

    ``extra`` adds query-specific CTEs after the fixture views, in order.
    """
    parts = [f"{n} AS ({_CTES[n][1]}\n)" for n in _resolve(names)]
    for name, sql in (extra or {}).items():
        parts.append(f"{name} AS ({sql}\n)")
    if not parts:
        return body
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        # The body has CTEs of its own: one WITH list, fixture views first.
        return "WITH " + ",\n".join(parts) + ",\n" + stripped[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
