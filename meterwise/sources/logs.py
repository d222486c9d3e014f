"""Usage logs: query history, metering, load history, billing and parameters.

On a live account these are log tables.  Here they are derived from the
``events`` table by the recipes of FIXTURES.md; every derivation is a
projection or a per-(warehouse, hour) aggregate, so it scales with the
events it reads and Catalyst pushes time filters down to the events scan.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.functions.timeutil import hour_floor, ntz, trunc, window_start
from meterwise.sources.tables import read_table


def query_history(events: DataFrame) -> DataFrame:
    """One row per query (event)."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = events.select("event_id", "user_id", "ts", "event_type", "value", k.alias("k"))
    path = F.when(F.col("k") % 2 == 0, F.lit("NATIVE")).otherwise(F.lit("BOOSTED"))
    tag = (F.when(F.col("event_type") == "purchase", F.concat(F.lit("WORKLOAD:TRAINING|PATH:"), path))
           .when(F.col("event_type") == "view",
                 F.concat(F.lit("WORKLOAD:INFERENCE|PATH:"), path,
                          F.when(F.col("k") % 3 == 0, F.lit("|SCHEDULED:TRUE")).otherwise(F.lit(""))))
           .when(F.col("event_type") == "click", F.lit("WORKLOAD:DATA_PREP"))
           .when(F.col("event_type") == "error", F.lit("WORKLOAD:INFERENCE")))
    elapsed = F.round(F.col("value") * 1000).cast("bigint")
    return e.select(
        F.col("event_id").alias("query_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
        F.when(F.col("user_id") % 4 == 0, F.lit(P.AUX_WAREHOUSE)).otherwise(F.lit(P.WAREHOUSE)).alias("warehouse_name"),
        F.col("ts").alias("start_time"),
        elapsed.alias("total_elapsed_time"),
        F.when(F.col("event_type") == "error", F.lit("FAIL")).otherwise(F.lit("SUCCESS")).alias("execution_status"),
        tag.alias("query_tag"),
        F.concat(F.lit("CALL job_"), F.col("event_type"), F.lit("("), F.col("k").cast("string"), F.lit(")")).alias("query_text"),
        F.when(F.col("k") % 5 == 0, F.col("k") * 10).otherwise(F.lit(0)).cast("bigint").alias("queued_overload_time"),
        ((F.col("k") % 7) * 100).cast("bigint").alias("queued_provisioning_time"),
        F.lit(0).cast("bigint").alias("queued_repair_time"),
        (F.col("k").cast("bigint") * 1048576).alias("bytes_scanned"),
        (F.col("k").cast("bigint") * 10).alias("rows_produced"),
        F.timestamp_add("MILLISECOND", elapsed, F.col("ts")).alias("end_time"),
    )


def metering_history(qh: DataFrame) -> DataFrame:
    """One row per warehouse and hour with the credits consumed."""
    credits = F.round(F.sum("total_elapsed_time") * 6 / F.lit(3600000.0), 6).cast("decimal(18,6)")
    return (qh.groupBy("warehouse_name", F.date_trunc("hour", "start_time").alias("_hour"))
            .agg(F.min("start_time").alias("start_time"),
                 (F.max("start_time") + F.expr("INTERVAL 30 MINUTES")).alias("end_time"),
                 credits.alias("credits_used"))
            .drop("_hour"))


def load_history(qh: DataFrame) -> DataFrame:
    """Average load per warehouse and hour."""
    hour = trunc("hour", "start_time")
    return (qh.groupBy("warehouse_name", hour.alias("start_time"))
            .agg((F.sum("total_elapsed_time") / F.lit(3600000.0)).alias("avg_running"),
                 (F.sum("queued_overload_time") / F.lit(3600000.0)).alias("avg_queued_load"),
                 (F.sum("queued_provisioning_time") / F.lit(3600000.0)).alias("avg_queued_provisioning"),
                 (F.sum(F.when(F.col("execution_status") == "FAIL", 1).otherwise(0)) / F.lit(60.0)).alias("avg_blocked"))
            .select("warehouse_name", "start_time", (F.col("start_time") + F.expr("INTERVAL 1 HOUR")).alias("end_time"),
                    "avg_running", "avg_queued_load", "avg_queued_provisioning", "avg_blocked"))


def billing_daily(meter: DataFrame) -> DataFrame:
    """Daily credits and amount due."""
    return (meter.groupBy(F.col("start_time").cast("date").alias("statement_date"))
            .agg(F.sum("credits_used").alias("credits_used"),
                 F.round(F.sum("credits_used").cast("double") * 3, 2).cast("decimal(18,2)").alias("amount_due")))


def cost_params(spark: SparkSession, rows=P.SEED_PARAMS, updated_at: dt.datetime | None = None) -> DataFrame:
    """The seeded cost parameter table (two rows).

    Built as a ``VALUES`` relation (a local relation in the plan), so the
    price look-ups of the reports run as cheap local sub-queries.
    """
    values = ", ".join(f"('{n}', CAST({float(v)!r} AS DOUBLE))" for n, v in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t(param_name, param_value)")
    stamp = (F.lit(updated_at.strftime("%Y-%m-%d %H:%M:%S")) if updated_at is not None
             else F.current_timestamp())
    return df.withColumn("updated_at", stamp.cast("timestamp"))


class UsageLogs:
    """The four usage logs of one data directory, derived lazily.

    ``since`` restricts the logs to whole hours from that time on.  Metering
    and load rows are per-hour aggregates, so cutting the events at an hour
    boundary yields exactly the log rows of those hours -- and the cut is a
    plain range predicate on the events scan (parquet row-group pruning),
    where a filter on the aggregated ``start_time`` could not be pushed.
    Each log is built on first use only.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, since: dt.datetime | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.since = since

    @cached_property
    def events(self) -> DataFrame:
        ev = read_table(self.spark, self.sf_dir, "events")
        return ev if self.since is None else ev.filter(F.col("ts") >= ntz(hour_floor(self.since)))

    @cached_property
    def qh(self) -> DataFrame:
        return query_history(self.events)

    @cached_property
    def meter(self) -> DataFrame:
        return metering_history(self.qh)

    @cached_property
    def load(self) -> DataFrame:
        return load_history(self.qh)

    @cached_property
    def billing(self) -> DataFrame:
        return billing_daily(self.meter)

    @cached_property
    def params(self) -> DataFrame:
        return cost_params(self.spark, updated_at=P.SEED_STAMP)


def materialize_hourly(logs: UsageLogs) -> UsageLogs:
    """Aggregate metering and load once and cut their lineage (reliable checkpoint).

    Both are per-(warehouse, hour) tables -- tiny next to the events they come
    from -- so a job running many reports reads them from the shared checkpoint
    folder instead of re-aggregating the events window for every report.
    """
    logs.meter = logs.meter.checkpoint(eager=True)
    logs.load = logs.load.checkpoint(eager=True)
    return logs


def usage_logs(spark: SparkSession, sf_dir: str, days: int | None = None, as_of: dt.datetime = P.AS_OF,
               since: dt.datetime | None = None) -> UsageLogs:
    """Logs of ``sf_dir``; with ``days``, only the hours a ``days`` report can touch."""
    if days is not None:
        since = window_start(as_of, days)
    return UsageLogs(spark, sf_dir, since)
