"""R2 for features: the per-track windows of F2 and F3 extended from stored running sums, not recomputed.

Each stored row carries its track's running sum and count up to its week, so a
row is all the state that later weeks need.  A batch of changed weeks rewrites,
of the tracks it names, the weeks from the first changed one on: running sums go
on from the row before, and the trailing windows reach back at most three rows.
Tracks are stored by hashed key, and only the buckets of changed tracks are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.session import scratch_path
from meterwise.sources.versions import VersionedTable
from meterwise.streaming.rollup import (MAX_FILES_PER_TRIGGER, MONTH, REGIONAL_KEYS, lineitem_stream, merge_sum, regional_sums)

SCHEMA = "isrc string, week_ending date, streams long, running_sum long, running_rows long, last_week_streams long, streams_last_4_weeks long"


def feature_table(spark: SparkSession, root: str, buckets: int = 64) -> VersionedTable:
    table = VersionedTable(spark, root, keys=["isrc"], buckets=buckets)
    table.create(spark.createDataFrame([], SCHEMA).schema)
    return table


def refresh_features(table: VersionedTable, changed: DataFrame, batch: str | None = None) -> DataFrame:
    """Set the plays of the ``changed`` (isrc, week_ending, streams) weeks, new or old, and carry their tracks' features on."""
    spark = table.spark
    schema = spark.createDataFrame([], SCHEMA).schema
    typed = changed.select("isrc", "week_ending", F.col("streams").cast("long").alias("new"))

    def carried(now: DataFrame) -> DataFrame:
        tracks = typed.select("isrc").distinct()
        mine = now.join(tracks, "isrc", "left_semi").withColumn("new", F.lit(None).cast("long"))
        added = typed.select("isrc", "week_ending", *[F.lit(None).cast("long").alias(f.name) for f in schema[2:]], "new")
        weeks = (mine.unionByName(added).groupBy("isrc", "week_ending")
                 .agg(*(F.max(f.name).alias(f.name) for f in schema[2:]), F.max("new").alias("new")))
        track, order = Window.partitionBy("isrc"), Window.partitionBy("isrc").orderBy("week_ending")
        so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        tail = F.col("week_ending") >= F.col("first")
        value = F.coalesce("new", "streams")
        out = weeks.withColumn("first", F.min(F.when(F.col("new").isNotNull(), F.col("week_ending"))).over(track)).withColumn("value", value)

        def from_stored(stored: str, own) -> F.Column:
            before = F.last(F.when(~tail, F.col(stored)), ignorenulls=True).over(so_far)
            return F.when(tail, F.coalesce(before, F.lit(0)) + F.sum(F.when(tail, own)).over(so_far)).otherwise(F.col(stored))

        out = out.select(
            "isrc", "week_ending", F.col("value").alias("streams"), from_stored("running_sum", F.col("value")).cast("long").alias("running_sum"),
            from_stored("running_rows", F.lit(1)).cast("long").alias("running_rows"),
            F.when(tail, F.coalesce(F.lag("value").over(order), F.lit(0))).otherwise(F.col("last_week_streams")).cast("long").alias("last_week_streams"),
            F.when(tail, F.sum("value").over(order.rowsBetween(-3, Window.currentRow))).otherwise(F.col("streams_last_4_weeks")).cast("long")
            .alias("streams_last_4_weeks"))
        return now.join(tracks, "isrc", "left_anti").unionByName(out)

    return table.rewrite(table.parts_of(typed), carried, schema=schema, batch=batch)


def features_of(rows: DataFrame) -> DataFrame:
    """The feature view (F3) of a stored feature table."""
    return rows.select("isrc", "week_ending", (F.col("running_sum") / F.col("running_rows")).alias("avg_streams_to_date"), "streams_last_4_weeks")


def incremental_features(spark: SparkSession, sf_dir: str, *, base: str | None = None, checkpoint: str | None = None, source: DataFrame | None = None,
                         max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """R2: shipment files -> exact weekly sums -> Global features, each batch carrying on what it changes."""
    from meterwise.sources.weekly import shipments_of

    dims = shipments_of(spark, sf_dir)
    stream = source if source is not None else lineitem_stream(spark, sf_dir, max_files_per_trigger)
    base = base or scratch_path(spark, "features_incremental")
    weekly, features = VersionedTable(spark, f"{base}/weekly", part=MONTH), feature_table(spark, f"{base}/features")

    def merge(batch: DataFrame, epoch_id: int) -> None:
        """Two commits under one epoch id; a replay after the first goes on with the second."""
        delta = regional_sums(dims(batch)).persist()
        parts = weekly.parts_of(delta)
        weekly.rewrite(parts, lambda now: merge_sum(now, delta, REGIONAL_KEYS, ["q"]), schema=delta.schema, batch=str(epoch_id))
        if not features.holds(str(epoch_id)):
            met = delta.select("p_brand", "week_ending").distinct()
            changed = (weekly.read(parts=parts).join(met, ["p_brand", "week_ending"], "left_semi")
                       .groupBy(F.col("p_brand").alias("isrc"), "week_ending").agg(F.sum(F.round("q").cast("bigint")).alias("streams")))
            refresh_features(features, changed, batch=str(epoch_id))
        delta.unpersist()
        weekly.expire()
        features.expire()

    (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint or scratch_path(spark, "features_ckpt"))
     .trigger(availableNow=True).start().awaitTermination())
    return features_of(features.read())
