"""R1 with state: each hourly window once, when the watermark has passed its end; late rows as corrections.

Spark drops rows behind the watermark before a stateful operator sees them.
Here nothing may be dropped, so the rows and the clock are two branches of the
stream: the clock carries the event times, whose watermark trails by the log's
latency, and no rows; the rows carry a time that is never late.  The query's
watermark is the smaller of both, the clock's.  Rows are combined per Arrow
batch before they are dealt out, so a task and the state see partial sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meterwise.functions.tags import workload_type
from meterwise.session import scratch_path
from meterwise.sources.logs import query_history
from meterwise.sources.versions import VersionedTable
from meterwise.streaming.rollup import LOG_LATENCY, MAX_FILES_PER_TRIGGER, events_stream

KEYS = ["warehouse_name", "workload_type", "window_start"]
_KEYS = ["warehouse_name", "workload_type", "start_ms"]
CLOSED, CORRECTION = "closed", "correction"
_NEVER_LATE = dt.datetime(2260, 1, 1)  # pandas counts nanoseconds up to 2262
_HOUR_MS = 3_600_000
_OUT = "warehouse_name string, workload_type string, start_ms long, kind string, query_count long, total_elapsed_ms long"

_TABLE = "warehouse_name string, workload_type string, window_start timestamp_ntz, kind string, query_count long, total_elapsed_ms long"


def _partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            yield batch.groupby(_KEYS, dropna=False, as_index=False, sort=False).sum()


def _close(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Sums of one window: kept until the watermark reaches its end, emitted once, and corrected after that."""
    end = int(key[2]) + _HOUR_MS

    def row(kind: str, queries: int, elapsed: int) -> pd.DataFrame:
        return pd.DataFrame([(*key, kind, queries, elapsed)], columns=[c.split()[0] for c in _OUT.split(", ")])

    if state.hasTimedOut:
        held = state.get
        state.remove()
        yield row(CLOSED, *held)
        return
    queries, elapsed = state.get if state.exists else (0, 0)
    for frame in frames:
        queries, elapsed = queries + int(frame["query_count"].sum()), elapsed + int(frame["total_elapsed_ms"].sum())
    watermark = state.getCurrentWatermarkMs()
    if end <= watermark:  # a window not yet emitted is closed with its late rows; one that was, or never began, is corrected
        kind = CLOSED if state.exists else CORRECTION
        if state.exists:
            state.remove()
        yield row(kind, queries, elapsed)
        return
    state.update((queries, elapsed))
    state.setTimeoutTimestamp(int(max(end - 1, watermark + 1)))


def hourly_events(queries: DataFrame, latency: str = LOG_LATENCY) -> DataFrame:
    """Streaming query-log rows -> (window, kind, sums): closed windows once each, and corrections."""
    rows = queries.select("warehouse_name", workload_type().alias("workload_type"), F.unix_millis(F.date_trunc("hour", "start_time").cast("timestamp")).alias("start_ms"),
                          F.col("start_time").cast("timestamp").alias("at"), F.lit(1).cast("long").alias("query_count"), F.col("total_elapsed_time").alias("total_elapsed_ms"))
    sums = "warehouse_name string, workload_type string, start_ms long, query_count long, total_elapsed_ms long"
    payload = (rows.select(*_KEYS, "query_count", "total_elapsed_ms").mapInPandas(_partial, sums)
               .withColumn("clock", F.lit(_NEVER_LATE).cast("timestamp")).withWatermark("clock", "0 seconds"))
    clock = (rows.select(*_KEYS, "query_count", "total_elapsed_ms", F.col("at").alias("clock")).withWatermark("clock", latency)
             .where(F.col("clock") < F.lit(dt.datetime(1, 1, 2)).cast("timestamp")))  # only its watermark is wanted
    return (payload.unionByName(clock).groupBy(*_KEYS)
            .applyInPandasWithState(_close, _OUT, "query_count long, total_elapsed_ms long", "append", GroupStateTimeout.EventTimeTimeout)
            .select("warehouse_name", "workload_type", F.timestamp_millis("start_ms").cast("timestamp_ntz").alias("window_start"),
                    "kind", "query_count", "total_elapsed_ms"))


def closed_hours_stream(spark: SparkSession, sf_dir: str, *, out: str | None = None, checkpoint: str | None = None, source: DataFrame | None = None,
                        max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """R1 with state: run to the end of the available files; the output table (closed windows and corrections).

    A batch's rows are appended under its epoch id, once however often the batch
    runs.  Windows still open stay in the state store for the next run.
    """
    stream = source if source is not None else events_stream(spark, sf_dir, max_files_per_trigger)
    table = VersionedTable(spark, out or scratch_path(spark, "closed_hours"))

    def append(batch: DataFrame, epoch_id: int) -> None:
        table.append(batch, batch=str(epoch_id))

    (hourly_events(query_history(stream)).writeStream.foreachBatch(append).outputMode("append")
     .option("checkpointLocation", checkpoint or scratch_path(spark, "closed_hours_ckpt"))
     .trigger(availableNow=True).start().awaitTermination())
    return table.create(spark.createDataFrame([], _TABLE).schema)


def corrected_hours(output: DataFrame) -> DataFrame:
    """Closed windows with their corrections added."""
    return output.groupBy(*KEYS).agg(F.sum("query_count").alias("query_count"), F.sum("total_elapsed_ms").alias("total_elapsed_ms"))
