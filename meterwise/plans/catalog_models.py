"""Registered streaming and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.operators import features as FT
from meterwise.operators.horizon import forecast_boosted
from meterwise.operators.models import score_region, train_gbt
from meterwise.operators.registry import ModelRegistry
from meterwise.plans import oracle as O
from meterwise.plans.catalog import register
from meterwise.plans.oracle import with_ctes
from meterwise.session import scratch_path
from meterwise.sources.weekly import weekly_input
from meterwise.streaming.rollup import hourly_usage_stream, incremental_metering, incremental_weekly_input

# ---------------------------------------------------------------- R1 / R2 ---

register("stream_hourly_usage", "R1", with_ctes(f"""
SELECT warehouse_name, workload_type, window_start, window_start + INTERVAL 1 HOUR AS window_end,
  count(*) AS query_count, cast(sum(total_elapsed_time) AS bigint) AS total_elapsed_ms,
  window_start + INTERVAL 1 HOUR <= (SELECT max(start_time) FROM qh) - INTERVAL 45 MINUTE AS closed
FROM (SELECT *, {O.workload_case()} AS workload_type, date_trunc('hour', start_time) AS window_start FROM qh) q
GROUP BY warehouse_name, workload_type, window_start""", "qh"))(lambda spark, d: hourly_usage_stream(spark, d))

register("stream_incremental_metering", "R2 S9", with_ctes("""
SELECT warehouse_name, date_trunc('hour', start_time) AS hour, count(*) AS query_count,
  cast(sum(total_elapsed_time) AS bigint) AS total_elapsed_ms,
  cast(cast(round(sum(total_elapsed_time) * 6 / cast(3600000 AS double), 6) AS decimal(18,6)) AS double) AS credits_used
FROM qh GROUP BY warehouse_name, date_trunc('hour', start_time)""", "qh"))(
    lambda spark, d: incremental_metering(spark, d).withColumn("credits_used", F.col("credits_used").cast("double")))

register("stream_weekly_input", "R2 S9 (weekly refresh)", with_ctes("SELECT * FROM weekly_input", "weekly_input"))(
    lambda spark, d: incremental_weekly_input(spark, d))

# ---------------------------------------------------------------- F5-F8 -----

def _gbt_scores(spark, d):
    weekly = weekly_input(spark, d, region="Global")
    model = train_gbt(FT.training_features(weekly))
    if isinstance(model, str):
        raise RuntimeError(model)
    registry = ModelRegistry(spark, scratch_path(spark, "models"))
    registry.log_model(model, "stream_forecast", "v1", comment="Global boosted trees")
    loaded = registry.get("stream_forecast", "v1")
    return score_region(loaded, FT.scoring_features(weekly))


register("gbt_scores", "F5 F6 F7 F8 S11 U2")(_gbt_scores)

# ---------------------------------------------------------------- F11 -------

register("forecast_boosted", "F11 (boosted tier)")(lambda spark, d: forecast_boosted(weekly_input(spark, d, region="Global")))


def _boosted_frame(spark, d):
    """What SQL can say of the boosted forecast: its series, dates and horizons, and that its bounds hold it."""
    fc = forecast_boosted(weekly_input(spark, d, region="Global"))
    inside = (F.col("lower_bound") <= F.col("forecast")) & (F.col("forecast") <= F.col("upper_bound")) & (F.col("lower_bound") >= 0)
    return fc.select("series", "ts", "horizon", inside.alias("bounded"))


register("forecast_boosted_frame", "F11 (boosted tier: keys, dates, horizons)", with_ctes(f"""
SELECT isrc AS series, CAST(last + 7 * CAST(h AS int) AS date) AS ts, CAST(h AS int) AS horizon, true AS bounded
FROM (SELECT isrc, max(week_ending) AS last FROM weekly_input WHERE region = 'Global' GROUP BY isrc) t,
  range(1, {P.FORECAST_HORIZON + 1}) AS r(h)""", "weekly_input"))(_boosted_frame)
