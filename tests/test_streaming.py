"""Streaming roll-ups equal their batch twins; the incremental merge survives several batches."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterwise.session import scratch_path
from meterwise.sources.logs import query_history
from meterwise.sources.tables import read_table
from meterwise.streaming.rollup import closed_windows, hourly_usage, hourly_usage_stream, incremental_metering
from tests.conftest import SF_SMALL
from tests.helpers import spark_rows


@pytest.mark.parametrize("files", [1, 4, 900])
def test_hourly_stream_does_not_depend_on_files(spark, files):
    """The same rows from 1, 4 and 900 files in random order, at the default and at small batch limits."""
    events = read_table(spark, SF_SMALL, "events")
    src_dir = scratch_path(spark, "events_files")
    events.orderBy(F.rand(7)).repartition(files).write.parquet(src_dir)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(1, files // 4)).parquet(src_dir)
    batch = closed_windows(hourly_usage(query_history(events)))
    assert spark_rows(hourly_usage_stream(spark, SF_SMALL, source=stream)) == spark_rows(batch)


def test_replayed_batch_changes_nothing(spark):
    """A batch that runs again from an empty stream checkpoint over its own epoch rewrites the same version."""
    base = scratch_path(spark, "hours")
    first = spark_rows(hourly_usage_stream(spark, SF_SMALL, out=base))
    assert spark_rows(hourly_usage_stream(spark, SF_SMALL, out=base)) == first


def test_incremental_merge_over_several_batches(spark):
    # Split the events into several files so the stream sees several micro-batches.
    src_dir = scratch_path(spark, "events_split")
    read_table(spark, SF_SMALL, "events").repartition(4, "event_id").write.parquet(src_dir)
    events = read_table(spark, SF_SMALL, "events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src_dir)
    table = incremental_metering(spark, SF_SMALL, source=stream)
    qh = query_history(events)
    expected = (qh.groupBy("warehouse_name", F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("hour"))
                .agg(F.count(F.lit(1)).alias("query_count"), F.sum("total_elapsed_time").alias("total_elapsed_ms")))
    got = table.select("warehouse_name", "hour", "query_count", "total_elapsed_ms")
    assert spark_rows(got) == spark_rows(expected)


def test_incremental_weekly_input_over_several_batches(spark):
    from meterwise.sources.tables import DECLARED
    from meterwise.sources.weekly import weekly_input
    from meterwise.streaming.rollup import incremental_weekly_input
    src_dir = scratch_path(spark, "lineitem_split")
    read_table(spark, SF_SMALL, "lineitem").repartition(4).write.parquet(src_dir)
    stream = spark.readStream.schema(DECLARED["lineitem"]).option("maxFilesPerTrigger", 1).parquet(src_dir)
    got = incremental_weekly_input(spark, SF_SMALL, source=stream)
    assert spark_rows(got) == spark_rows(weekly_input(spark, SF_SMALL))


@pytest.mark.parametrize("files,limit", [(1, 1), (4, 1), (900, 300)])
def test_fractional_quantities_do_not_depend_on_files(spark, files, limit):
    """Sums are exact until they are read: 0.3 more on every row gives one table however rows fall into batches."""
    from meterwise.sources.tables import DECLARED
    from meterwise.sources.weekly import shipments_of
    from meterwise.streaming.rollup import incremental_weekly_input, regional_sums, weekly_of
    rows = read_table(spark, SF_SMALL, "lineitem").withColumn("l_quantity", (F.col("l_quantity") + 0.3).cast("double"))
    src_dir = scratch_path(spark, "fractions")
    rows.orderBy(F.rand(3)).repartition(files).write.parquet(src_dir)
    stream = spark.readStream.schema(DECLARED["lineitem"]).option("maxFilesPerTrigger", limit).parquet(src_dir)
    base = scratch_path(spark, "weekly_fractions")
    got = incremental_weekly_input(spark, SF_SMALL, source=stream, base=base)
    assert spark_rows(got) == spark_rows(weekly_of(regional_sums(shipments_of(spark, SF_SMALL)(rows))))
    from meterwise.sources.versions import VersionedTable
    table = VersionedTable(spark, base)
    manifest = table.manifest()
    parts = [f["part"] for f in manifest["files"]]
    assert len(parts) == len(set(parts)) and len(table._versions()) <= 2  # a file a month, whatever wrote it
    kept = sum(len(table._fs().listStatus(s.getPath())) > 0 for s in table._fs().listStatus(table._path("_data")))
    assert kept <= 2 * len(set(parts))


def late_files(spark, files, seed):
    """The events in ``files`` files: mostly in time order, with a third of the rows thrown anywhere (some hours or weeks late)."""
    events = read_table(spark, SF_SMALL, "events")
    src_dir = scratch_path(spark, "late_events")
    scattered = F.when(F.rand(seed) < 0.33, F.rand(seed + 1)).otherwise(F.percent_rank().over(Window.orderBy("ts")))
    (events.withColumn("_at", scattered).repartitionByRange(files, "_at").sortWithinPartitions("_at").drop("_at").write.parquet(src_dir))
    return events, src_dir


@pytest.mark.parametrize("files", [1, 4, 40])
def test_windows_close_once_and_late_rows_are_corrections(spark, files):
    from meterwise.streaming.closing import CLOSED, CORRECTION, closed_hours_stream, corrected_hours
    events, src_dir = late_files(spark, files, 5)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(1, files // 8)).parquet(src_dir)
    out = closed_hours_stream(spark, SF_SMALL, source=stream)
    merged = closed_windows(hourly_usage(query_history(events))).where("closed")
    columns = ["warehouse_name", "workload_type", "window_start", "query_count", "total_elapsed_ms"]
    assert spark_rows(corrected_hours(out).select(*columns)) == spark_rows(merged.select(*columns))
    kinds = {r["kind"]: r["count"] for r in out.groupBy("kind").count().collect()}
    assert (CORRECTION in kinds) == (files > 1)
    once = out.where(F.col("kind") == CLOSED).groupBy("warehouse_name", "workload_type", "window_start").count()
    assert once.where("count > 1").isEmpty()


def test_windows_close_once_over_a_restart(spark):
    """Two runs on one checkpoint: the second starts from the first's state store."""
    from meterwise.streaming.closing import closed_hours_stream, corrected_hours
    events = read_table(spark, SF_SMALL, "events")
    src_dir, out, checkpoint = scratch_path(spark, "restarted"), scratch_path(spark, "restarted_out"), scratch_path(spark, "restarted_ckpt")
    halves = [events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")]
    for half in halves:
        half.write.mode("append").parquet(src_dir)
        stream = spark.readStream.schema(events.schema).parquet(src_dir)
        got = closed_hours_stream(spark, SF_SMALL, source=stream, out=out, checkpoint=checkpoint)
    columns = ["warehouse_name", "workload_type", "window_start", "query_count", "total_elapsed_ms"]
    merged = closed_windows(hourly_usage(query_history(events))).where("closed")
    assert spark_rows(corrected_hours(got).select(*columns)) == spark_rows(merged.select(*columns))
    again = closed_hours_stream(spark, SF_SMALL, source=spark.readStream.schema(events.schema).parquet(src_dir), out=out, checkpoint=checkpoint)
    assert again.count() == got.count()  # nothing new: nothing emitted


@pytest.mark.parametrize("files,limit", [(1, 1), (4, 1), (30, 7)])
def test_incremental_features_equal_the_full_ones(spark, files, limit):
    from meterwise.operators.features import stream_features
    from meterwise.sources.tables import DECLARED
    from meterwise.sources.weekly import weekly_input
    from meterwise.streaming.features import incremental_features
    src_dir = scratch_path(spark, "feature_files")
    read_table(spark, SF_SMALL, "lineitem").orderBy(F.rand(9)).repartition(files).write.parquet(src_dir)
    stream = spark.readStream.schema(DECLARED["lineitem"]).option("maxFilesPerTrigger", limit).parquet(src_dir)
    got = incremental_features(spark, SF_SMALL, source=stream)
    assert spark_rows(got) == spark_rows(stream_features(weekly_input(spark, SF_SMALL)))


def test_refresh_reads_and_rewrites_only_changed_tracks(spark):
    import datetime as dt

    from meterwise.operators.features import stream_features
    from meterwise.streaming.features import feature_table, features_of, refresh_features
    week = lambda k: dt.date(2024, 1, 6) + dt.timedelta(7 * k)
    plays = {(f"T{t}", week(k)): t * 10 + k for t in range(40) for k in range(0, 12, 1 + t % 2)}
    frame = lambda rows: spark.createDataFrame([(i, w, n) for (i, w), n in rows.items()], "isrc string, week_ending date, streams long")
    table = feature_table(spark, scratch_path(spark, "features"), buckets=16)
    refresh_features(table, frame(plays), batch="a")
    before = {f["path"] for f in table.manifest()["files"]}
    changes = {("T3", week(4)): 1000, ("T3", week(20)): 7, ("T8", week(0)): 5, ("new", week(1)): 2}
    refresh_features(table, frame(changes), batch="b")
    parts = table.parts_of(frame(changes))
    kept = {f["path"] for f in table.manifest()["files"] if f["part"] not in parts}
    assert kept == {f for f in before if f in kept} and len(parts) <= 3
    weekly = frame(plays | changes).withColumn("region", F.lit("Global"))
    assert spark_rows(features_of(refresh_features(table, frame(changes), batch="b"))) == spark_rows(stream_features(weekly))
