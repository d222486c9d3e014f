"""Incremental usage roll-ups with Structured Streaming.

R1 ``hourly_usage_stream``: query log rows -> one-hour windows per warehouse
    and workload, merged by key batch by batch, so that a late row updates its
    window whatever the number and order of files.  The log latency only
    decides the ``closed`` flag of a window; no row is dropped for lateness.
R1 ``closed_hours_stream``: the same windows from the state store: each is
    emitted once, when the watermark has passed its end, and rows that come
    later go to a corrections output instead of being dropped.
R2 ``incremental_metering``, ``incremental_weekly_input``: each micro-batch is
    aggregated and merged into the running table with ``foreachBatch``.

Merged tables are versioned (``sources.versions``): a batch rewrites the days or
months it touches, one file each whatever wrote them, and commits them with its
epoch id in one rename, so a replayed batch changes nothing.  One manifest says
where everything is; no folder is listed and replaced files are removed.

Checkpoints and outputs live under ``spark.checkpoint.dir`` (shared storage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.functions.tags import workload_type
from meterwise.session import scratch_path
from meterwise.sources.logs import query_history
from meterwise.sources.tables import DECLARED, table_path
from meterwise.sources.versions import VersionedTable

LOG_LATENCY = "45 minutes"
# Files per micro-batch: ``availableNow`` still processes everything, but in
# bounded batches, so a back-fill over a long history never forms one giant
# batch.  Batches are merged by key, so the limit cannot change a result.
MAX_FILES_PER_TRIGGER = 256


def events_stream(spark: SparkSession, sf_dir: str,
                  max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Stream the events table's files (schema taken from the table, not inferred per batch)."""
    path = table_path(sf_dir, "events")
    reader = spark.readStream.schema(DECLARED["events"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A file source needs a folder or a glob; the one-character class selects this file.
    return reader.parquet(path[:-1] + "[" + path[-1] + "]")


def hourly_usage(qh: DataFrame) -> DataFrame:
    """Queries, elapsed milliseconds and last query start per (warehouse, workload, hour)."""
    return (qh.groupBy("warehouse_name", workload_type().alias("workload_type"),
                       F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("window_start"))
            .agg(F.count(F.lit(1)).alias("query_count"), F.sum("total_elapsed_time").alias("total_elapsed_ms"),
                 F.max("start_time").alias("last_start")))


def closed_windows(hours: DataFrame, latency: str = LOG_LATENCY) -> DataFrame:
    """Add ``window_end`` and ``closed``: whether the log has passed the window's end by its latency."""
    seen = hours.agg(F.max("last_start")).scalar()
    end = F.col("window_start") + F.expr("INTERVAL 1 HOUR")
    return hours.select("warehouse_name", "workload_type", "window_start", end.alias("window_end"), "query_count",
                        "total_elapsed_ms", (end <= seen - F.expr(f"INTERVAL {latency}")).alias("closed"))


def hourly_usage_stream(spark: SparkSession, sf_dir: str, *, out: str | None = None, checkpoint: str | None = None,
                        source: DataFrame | None = None,
                        max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Merge the available files into the hourly table; every window, with its ``closed`` flag."""
    stream = source if source is not None else events_stream(spark, sf_dir, max_files_per_trigger)
    hours = _merge_stream(spark, stream, lambda batch: hourly_usage(query_history(batch)),
                          ["warehouse_name", "workload_type", "window_start"],
                          ["query_count", "total_elapsed_ms"], part="to_date(window_start)", latest=["last_start"],
                          base=out or scratch_path(spark, "hourly_usage"),
                          checkpoint=checkpoint or scratch_path(spark, "hourly_usage_ckpt"))
    return closed_windows(hours)


# ----------------------------------------------------------------- R2 -------

def _batch_hours(batch: DataFrame) -> DataFrame:
    qh = query_history(batch)
    return (qh.groupBy("warehouse_name", F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("hour"))
            .agg(F.count(F.lit(1)).alias("query_count"), F.sum("total_elapsed_time").alias("total_elapsed_ms")))


def merge_sum(current: DataFrame, delta: DataFrame, keys, measures, latest=()) -> DataFrame:
    """Keyed merge: measures add up, the columns in ``latest`` take the greater value."""
    sums = [F.sum(m).cast(delta.schema[m].dataType).alias(m) for m in measures]
    return current.unionByName(delta).groupBy(*keys).agg(*sums, *(F.max(c).alias(c) for c in latest))


def _merge_stream(spark: SparkSession, stream: DataFrame, batch_agg, keys, measures, *, base: str,
                  checkpoint: str, part: str, latest=()) -> DataFrame:
    """Run ``stream`` to the end of the available files, merging each batch into the versioned table ``base``.

    ``part`` is the expression of the keys the table is stored by (a day or a
    month).  The parts of a batch reach the driver; only they are read and rewritten.
    """
    table = VersionedTable(spark, base, part=part)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        if table.holds(str(epoch_id)):
            return
        delta = batch_agg(batch).persist()
        table.rewrite(table.parts_of(delta), lambda now: merge_sum(now, delta, keys, measures, latest), schema=delta.schema, batch=str(epoch_id))
        delta.unpersist()
        table.expire()

    (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return table.create(batch_agg(spark.createDataFrame([], stream.schema)).schema)


def incremental_metering(spark: SparkSession, sf_dir: str, *, base: str | None = None,
                         checkpoint: str | None = None, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                         source: DataFrame | None = None) -> DataFrame:
    """R2: keep a per-(warehouse, hour) usage table current, batch by batch."""
    stream = source if source is not None else events_stream(spark, sf_dir, max_files_per_trigger)
    table = _merge_stream(spark, stream, _batch_hours, ["warehouse_name", "hour"],
                          ["query_count", "total_elapsed_ms"], part="to_date(hour)",
                          base=base or scratch_path(spark, "metering_incremental"),
                          checkpoint=checkpoint or scratch_path(spark, "metering_incremental_ckpt"))
    return table.withColumn(
        "credits_used", F.round(F.col("total_elapsed_ms") * 6 / F.lit(3600000.0), 6).cast("decimal(18,6)"))


def lineitem_stream(spark: SparkSession, sf_dir: str,
                    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    reader = spark.readStream.schema(DECLARED["lineitem"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = table_path(sf_dir, "lineitem")
    return reader.parquet(path[:-1] + "[" + path[-1] + "]")


def incremental_weekly_input(spark: SparkSession, sf_dir: str, *, base: str | None = None,
                             checkpoint: str | None = None, source: DataFrame | None = None,
                             max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """R2: keep the weekly input current as new shipment files arrive.

    Each batch of lineitem rows joins the static part and supplier-region
    tables (stream-static joins), is summed per (region, track, week) and merged
    by key into the stored table, by month.  Stored sums are exact decimals;
    they are rounded, and the Global rows derived from them, on reading, so the
    table does not depend on how rows fall into batches.
    """
    from meterwise.sources.weekly import shipments_of

    dims = shipments_of(spark, sf_dir)
    stream = source if source is not None else lineitem_stream(spark, sf_dir, max_files_per_trigger)
    table = _merge_stream(spark, stream, lambda batch: regional_sums(dims(batch)), REGIONAL_KEYS, ["q"], part=MONTH,
                          base=base or scratch_path(spark, "weekly_incremental"),
                          checkpoint=checkpoint or scratch_path(spark, "weekly_incremental_ckpt"))
    return weekly_of(table)


REGIONAL_KEYS = ["r_name", "p_brand", "week_ending"]
MONTH = "date_format(week_ending, 'yyyy-MM')"


def regional_sums(rows: DataFrame) -> DataFrame:
    """Exact plays per (region, track, week)."""
    return rows.groupBy(*REGIONAL_KEYS).agg(F.sum(F.col("l_quantity").cast("decimal(28,9)")).cast("decimal(38,9)").alias("q"))


def weekly_of(regional: DataFrame) -> DataFrame:
    """The weekly input from exact regional sums: rounded regional rows and their Global totals, in one aggregation."""
    from meterwise.sources.weekly import GLOBAL, track_columns

    both = (regional.withColumn("q", F.round("q").cast("bigint"))
            .groupingSets([[F.col(c) for c in REGIONAL_KEYS], [F.col("p_brand"), F.col("week_ending")]], *REGIONAL_KEYS)
            .agg(F.sum("q").alias("streams")))
    return both.select(F.coalesce("r_name", F.lit(GLOBAL)).alias("region"), *track_columns(F.col("p_brand")), "week_ending", F.col("streams").cast("bigint"))
