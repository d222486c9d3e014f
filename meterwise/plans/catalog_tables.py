"""Registered write-and-read-back queries: stored tables, merges, appends, stored forecasts and feature views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.operators import costs as C
from meterwise.operators import features as FT
from meterwise.operators import forecast as FC
from meterwise.operators.quality import assert_quality, quality_report
from meterwise.operators.registry import FeatureViewRegistry
from meterwise.plans import oracle as O
from meterwise.plans.catalog import _billing_since, register
from meterwise.plans.catalog_dashboard import _BILLED
from meterwise.plans.catalog_series import _FV_SQL, QUALITY_SQL, _forecast_sql
from meterwise.plans.oracle import with_ctes
from meterwise.schemas import COST_PARAMS, FORECAST_OUTPUT, WEEKLY_INPUT, conform
from meterwise.session import materialised, scratch_path
from meterwise.sources.logs import cost_params, usage_logs
from meterwise.sources.sinks import set_param
from meterwise.sources.tables import read_table
from meterwise.sources.versions import VersionedTable
from meterwise.sources.weekly import load_weekly, store_weekly, weekly_input
from meterwise.streaming.closing import closed_hours_stream, corrected_hours
from meterwise.streaming.features import incremental_features

KEYS = ["region", "isrc", "week_ending"]
#: The merge query updates and inserts from this week on.
MERGE_FROM = "1998-01-01"

# ---------------------------------------------------------------- S1 --------


def _stored_scan(spark, d):
    """The region-partitioned table joined with a filtered dimension: only the folders of the regions that are left are read."""
    stored = load_weekly(spark, store_weekly(weekly_input(spark, d), scratch_path(spark, "weekly_by_region")))
    kept = read_table(spark, d, "region").filter(F.col("r_name").startswith("A")).select(F.col("r_name").alias("region"))
    return stored.join(kept, "region").select(*[f.name for f in WEEKLY_INPUT])


register("stored_weekly_pruned", "S1 S6", with_ctes("SELECT * FROM weekly_input WHERE region LIKE 'A%'", "weekly_input"))(_stored_scan)

# ----------------------------------------------------- S5 - S10, C4 ---------


def _replaced(spark, d):
    """Created empty, filled, then replaced by a validated rewrite of itself."""
    table = VersionedTable(spark, scratch_path(spark, "replaced"))
    table.create(WEEKLY_INPUT)
    table.replace(weekly_input(spark, d))

    def filled(rows):
        if rows.isEmpty():
            raise ValueError("nothing to replace the table with")

    return table.replace(conform(table.read().withColumn("streams", F.col("streams") * 2), WEEKLY_INPUT), validate=filled)


register("table_replaced", "S5 S6 S8", with_ctes("SELECT * REPLACE (cast(streams * 2 AS bigint) AS streams) FROM weekly_input", "weekly_input"))(_replaced)


def _appended(spark, d):
    """Regional rows and Global rows appended as two batches, both replayed."""
    weekly = weekly_input(spark, d)
    batches = {"regions": weekly.filter(F.col("region") != FT.GLOBAL), "global": weekly.filter(F.col("region") == FT.GLOBAL)}
    table = VersionedTable(spark, scratch_path(spark, "appended"))
    table.create(WEEKLY_INPUT)
    for name, rows in [*batches.items(), *batches.items()]:
        table.append(rows, batch=name)
    return table.read()


register("table_appended_once", "S5 S7", with_ctes("SELECT * FROM weekly_input", "weekly_input"))(_appended)


def _merged(spark, d):
    """Weeks from a date on merged into a table that holds the even weeks: updates, inserts, and rows left alone."""
    weekly = materialised(weekly_input(spark, d), "weekly")
    table = VersionedTable(spark, scratch_path(spark, "merged"), keys=KEYS, buckets=16)
    table.replace(weekly.filter(F.weekofyear("week_ending") % 2 == 0))
    source = weekly.filter(F.col("week_ending") >= F.lit(MERGE_FROM).cast("date")).withColumn("streams", F.col("streams") + 1)
    return table.merge(source, batch="late weeks")


register("table_merged", "S9", with_ctes(f"""
SELECT * REPLACE (CASE WHEN week_ending >= DATE '{MERGE_FROM}' THEN streams + 1 ELSE streams END AS streams) FROM weekly_input
WHERE weekofyear(week_ending) % 2 = 0 OR week_ending >= DATE '{MERGE_FROM}'""", "weekly_input"))(_merged)


def _updated_params(spark, d):
    """The seeded parameters stored, the billed price set as the dollars per credit, read through the dashboard's view."""
    table = VersionedTable(spark, scratch_path(spark, "params"), keys=["param_name"])
    table.replace(conform(cost_params(spark, updated_at=P.SEED_STAMP), COST_PARAMS))
    billing = usage_logs(spark, d, since=_billing_since()).billing
    table.replace(conform(set_param(table.read(), P.DOLLARS_PER_CREDIT, C.observed_price(billing), stamp=P.AS_OF), COST_PARAMS))
    return C.cost_params_view(table.read())


register("cost_params_updated", "S6 S10 C4", with_ctes(f"""
SELECT param_name, CASE WHEN param_name = '{P.DOLLARS_PER_CREDIT}' THEN {_BILLED} ELSE param_value END AS param_value FROM params""",
    "billing", "params"))(_updated_params)

# ------------------------------------------------------------ F12, Q, W1 ----


def _stored_forecast(spark, d):
    """The fitted model and its forecast, stored and read back."""
    models = VersionedTable(spark, scratch_path(spark, "trend_models"))
    model = models.replace(FC.fit_trend(weekly_input(spark, d, region="Global"), series_cols=["isrc"]))
    forecasts = VersionedTable(spark, scratch_path(spark, "forecasts"))
    forecasts.create(FORECAST_OUTPUT)
    return forecasts.replace(FC.forecast(model))


register("stored_forecast", "F10 F11 F12", with_ctes(_forecast_sql("isrc"), "weekly_input"))(_stored_forecast)

register("strict_quality", "Q1 Q2 Q3 Q4 Q5 Q6 (strict)", with_ctes(QUALITY_SQL, "weekly_input"))(
    lambda spark, d: assert_quality(quality_report(weekly_input(spark, d))))


def _latest(spark, d):
    newest = Window.partitionBy("region", "isrc").orderBy(F.col("week_ending").desc())
    return (weekly_input(spark, d).withColumn("_k", F.row_number().over(newest)).filter("_k = 1")
            .select("region", "isrc", "week_ending", "streams"))


register("latest_weekly", "W1", with_ctes("""
SELECT region, isrc, week_ending, streams FROM weekly_input
QUALIFY row_number() OVER (PARTITION BY region, isrc ORDER BY week_ending DESC) = 1""", "weekly_input"))(_latest)

# ---------------------------------------------------------------- F4, J6 ----

SPINE_REGION, SPINE_LAG_DAYS, OTHER_REGION = "EUROPE", 10, "AMERICA"


def _asof_views(spark, d):
    """Two registered feature views looked up together at the spine's times; the shipments are read once."""
    weekly = materialised(weekly_input(spark, d), "weekly")
    registry = FeatureViewRegistry(spark, scratch_path(spark, "feature_views"))
    for name, region in (("world", FT.GLOBAL), ("other", OTHER_REGION)):
        registry.register_view(FT.stream_features(weekly, region=region), name, "v1", ["isrc"], "week_ending")
    spine = weekly.filter(F.col("region") == SPINE_REGION).select("isrc", F.date_add("week_ending", SPINE_LAG_DAYS).alias("ts"))
    return FT.features_asof_views(spine, {n: (registry.read_view(n, "v1"), "week_ending") for n in ("world", "other")}, key="isrc", spine_ts="ts")


register("features_asof_views", "F4 J6", with_ctes(f"""
SELECT s.isrc, s.ts, w.week_ending AS world_week_ending, w.avg_streams_to_date AS world_avg_streams_to_date,
  w.streams_last_4_weeks AS world_streams_last_4_weeks, o.week_ending AS other_week_ending,
  o.avg_streams_to_date AS other_avg_streams_to_date, o.streams_last_4_weeks AS other_streams_last_4_weeks
FROM (SELECT isrc, week_ending + {SPINE_LAG_DAYS} AS ts FROM weekly_input WHERE region = '{SPINE_REGION}') s
ASOF LEFT JOIN fv w ON s.isrc = w.isrc AND s.ts >= w.week_ending
ASOF LEFT JOIN fo o ON s.isrc = o.isrc AND s.ts >= o.week_ending""", "weekly_input",
    extra={"fv": _FV_SQL, "fo": _FV_SQL.replace("'Global'", f"'{OTHER_REGION}'")}))(_asof_views)

# ---------------------------------------------------------------- R1, R2 ----

register("stream_closed_hours", "R1 (state store)", with_ctes(f"""
SELECT warehouse_name, workload_type, window_start, count(*) AS query_count, cast(sum(total_elapsed_time) AS bigint) AS total_elapsed_ms
FROM (SELECT *, {O.workload_case()} AS workload_type, date_trunc('hour', start_time) AS window_start FROM qh) q
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(start_time) FROM qh) - INTERVAL 45 MINUTE
GROUP BY warehouse_name, workload_type, window_start""", "qh"))(lambda spark, d: corrected_hours(closed_hours_stream(spark, d)))

register("stream_incremental_features", "R2 F3", with_ctes(_FV_SQL, "weekly_input"))(lambda spark, d: incremental_features(spark, d))
