"""Cost estimation from observed usage, and the parameter refresh.

The estimator (C1) is a Column expression; the scenarios (C2) and the
preflight (C3) feed it figures measured from the logs -- metered hours,
credits per hour, billed price and a job's past runtime -- so their work grows
with the logs they read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.functions.cost import estimate_cost
from meterwise.functions.timeutil import diff_units, ntz, window_start
from meterwise.operators.attribution import query_window
from meterwise.operators.reports import meter_window, param_value
from meterwise.sources.sinks import upsert


def _rate() -> F.Column:
    """Credits per metered hour (A19, unrounded) as an aggregate over metering rows."""
    return F.sum("credits_used").cast("double") / F.nullif(F.sum(diff_units("minute", "start_time", "end_time")) / F.lit(60), F.lit(0.0))


def observed_price(billing: DataFrame, *, as_of_date: dt.date = P.AS_OF_DATE, months: int = 3) -> F.Column:
    """Billed dollars per credit over the last months as a scalar."""
    b = billing.filter(F.col("statement_date") >= F.add_months(F.lit(as_of_date), -months))
    return b.select(F.round(F.sum("amount_due").cast("double")
                            / F.nullif(F.sum("credits_used").cast("double"), F.lit(0.0)), 4)).scalar()


def estimate_scenarios(meter: DataFrame, params: DataFrame, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=7,
                       sizes=P.SIZE_SCENARIOS) -> DataFrame:
    """The window's metered hours priced on each size of the ladder.

    One row per size; the size ladder is a literal of three rows, stacked on
    the one row of the window's hours.
    """
    price = param_value(params, P.DOLLARS_PER_CREDIT)
    ladder = ", ".join(f"'{s}', CAST({r} AS DOUBLE)" for s, r, _ in sizes)
    est = estimate_cost(F.col("runtime_hours"), F.col("credits_per_hour"), price)
    m = meter_window(meter, wh=wh, as_of=as_of, days=days)  # the row of the sum is the row the ladder is stacked on
    return (m.agg((F.sum(diff_units("minute", "start_time", "end_time")) / F.lit(60.0)).alias("_h"))
            .selectExpr("_h", f"stack({len(sizes)}, {ladder}) AS (size, credits_per_hour)")
            .withColumn("runtime_hours", F.round("_h", 6))
            .withColumn("cost_estimate", est)
            .select("size", "runtime_hours", "credits_per_hour",
                    F.round("cost_estimate.estimated_credits", 6).alias("estimated_credits"),
                    F.round("cost_estimate.estimated_dollars", 6).alias("estimated_dollars")))


def job_scenarios(qh: DataFrame, params: DataFrame, *, wh=P.WAREHOUSE, as_of=P.AS_OF, days=30) -> DataFrame:
    """The two planned jobs on the medium rate, beside what such jobs took in the log (one pass).

    Observed: the mean training run, and 30 days of the mean daily inference time.
    """
    q = query_window(qh, wh=wh, as_of=as_of, days=days)
    training, inference = (F.col("query_tag").contains(f"WORKLOAD:{w}") for w in ("TRAINING", "INFERENCE"))
    hours = q.agg((F.avg(F.when(training, F.col("total_elapsed_time"))) / F.lit(3600000.0)).alias("a"),
                  (F.lit(30.0) * F.sum(F.when(inference, F.col("total_elapsed_time"))) / F.lit(3600000.0)
                   / F.nullif(F.count_distinct(F.when(inference, F.col("start_time").cast("date"))), F.lit(0))).alias("b"))
    rate, price = param_value(params, P.MEDIUM_CREDITS_PER_HOUR), param_value(params, P.DOLLARS_PER_CREDIT)
    rows = F.array(*(F.struct(F.lit(n).alias("scenario"), F.lit(h).alias("planned_hours"), F.col(c).alias("observed_hours"))
                     for (n, h), c in zip(P.JOB_SCENARIOS, ("a", "b"))))
    planned, observed = (estimate_cost(F.col(c), rate, price) for c in ("planned_hours", "observed_hours"))
    return (hours.select(F.explode(rows).alias("r")).select("r.*")
            .select("scenario", "planned_hours", F.round(planned.getField("estimated_credits"), 6).alias("planned_credits"),
                    F.round(planned.getField("estimated_dollars"), 6).alias("planned_dollars"), F.round("observed_hours", 6).alias("observed_hours"),
                    F.round(observed.getField("estimated_credits"), 6).alias("observed_credits"),
                    F.round(observed.getField("estimated_dollars"), 6).alias("observed_dollars")))


def preflight_estimate(qh: DataFrame, meter: DataFrame, billing: DataFrame, params: DataFrame, *,
                       job_pattern: str = "%job_purchase%", wh=P.WAREHOUSE, as_of=P.AS_OF, days=7) -> DataFrame:
    """Expected runtime (A21) x observed rate (A19) x billed price.

    A second estimate uses the configured large-warehouse rate, which set-up
    never seeds: it stays NULL, as the SQL estimator returns for a NULL input.
    """
    runtime_h = (qh.filter((F.col("start_time") >= ntz(window_start(as_of, days)))
                           & F.col("query_text").ilike(job_pattern))
                 .select(F.avg(diff_units("minute", "start_time", "end_time")) / F.lit(60.0)).scalar())
    price = observed_price(billing)
    large = param_value(params, P.LARGE_CREDITS_PER_HOUR)
    m = meter_window(meter, wh=wh, as_of=as_of, days=days)  # the rate's own row carries the others
    base = m.agg(_rate().alias("_rate"))
    rate = F.col("_rate")
    est = estimate_cost(runtime_h, rate, price)
    large_est = estimate_cost(runtime_h, large, param_value(params, P.DOLLARS_PER_CREDIT))
    return base.select(
        F.round(runtime_h, 6).alias("runtime_hours"), F.round(rate, 6).alias("credits_per_hour"),
        price.alias("dollars_per_credit"),
        F.round(est.getField("estimated_credits"), 6).alias("estimated_credits"),
        F.round(est.getField("estimated_dollars"), 6).alias("estimated_dollars"),
        F.round(large_est.getField("estimated_credits"), 6).alias("large_estimated_credits"),
        F.round(large_est.getField("estimated_dollars"), 6).alias("large_estimated_dollars"))


def cost_params_view(params: DataFrame) -> DataFrame:
    """C4: parameter name -> value, with the dashboard defaults when absent."""
    names = [n for n, _ in P.SEED_PARAMS]
    present = params.select("param_name", "param_value")
    spark = params.sparkSession
    defaults = spark.createDataFrame([(n, float(P.PARAM_DEFAULTS[n])) for n in names],
                                     "param_name string, default_value double")
    return (defaults.join(present, "param_name", "full_outer")
            .select("param_name", F.coalesce("param_value", "default_value").alias("param_value")))


def refresh_cost_params(params: DataFrame, meter: DataFrame, billing: DataFrame, *, wh=P.WAREHOUSE,
                        as_of=P.AS_OF, days=7) -> DataFrame:
    """Upsert the billed price and the observed credit rate.

    DOLLARS_PER_CREDIT is updated from billing; OBSERVED_CREDITS_PER_HOUR is
    inserted (or updated); untouched rows keep their stamp.
    """
    src = (meter_window(meter, wh=wh, as_of=as_of, days=days).agg(_rate().alias("_rate"))
           .select(F.explode(F.array(
               F.struct(F.lit(P.DOLLARS_PER_CREDIT).alias("param_name"),
                        observed_price(billing).alias("param_value")),
               F.struct(F.lit("OBSERVED_CREDITS_PER_HOUR").alias("param_name"),
                        F.round("_rate", 6).alias("param_value")),
           )).alias("s")).select("s.*"))
    return upsert(params, src, ["param_name"], stamp_col="updated_at", stamp=as_of)
