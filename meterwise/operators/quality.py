"""Data-quality rules of the weekly input as one (rule, failed, total) report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise import params as P

PK = ("region", "isrc", "week_ending")


def _row(rule: str, failed, total) -> list:
    return [F.lit(rule).alias("rule"), failed.cast("bigint").alias("failed"), total.cast("bigint").alias("total")]


def quality_report(weekly: DataFrame, *, allowed_regions=P.ALLOWED_REGIONS, global_region: str = "Global",
                   min_weeks: int = P.MIN_HISTORY_WEEKS) -> DataFrame:
    """Q1-Q6 in one chain of aggregations (no branches, so the input is read once).

    1. per primary key: row count and the row-rule counts (partial aggregation first);
    2. per track: sums of those, the smallest and largest track name (two names
       differ exactly when the track has more than one), and its Global weeks
       (each key group is one distinct week);
    3. one global row, unpivoted into (rule, failed, total).
    """
    c = F.col("c")
    pk_null = F.col("region").isNull() | F.col("isrc").isNull() | F.col("week_ending").isNull()
    bad_region = ~F.coalesce(F.col("region").isin(*allowed_regions), F.lit(False))
    is_global = F.col("region") == global_region
    keys = (weekly.groupBy(*PK)
            .agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("streams") < 0).alias("neg"),
                 F.min("track").alias("t0"), F.max("track").alias("t1"))
            .select("isrc", "c", "neg", "t0", "t1",
                    F.when(F.dayofweek("week_ending") != 7, c).otherwise(0).alias("not_sat"),
                    F.when(bad_region, c).otherwise(0).alias("bad_region"),
                    F.when(pk_null, c).otherwise(0).alias("pk_null"),
                    F.when(c > 1, 1).otherwise(0).alias("dup"),
                    F.coalesce(is_global, F.lit(False)).alias("g"),
                    F.coalesce(is_global & F.col("week_ending").isNotNull(), F.lit(False)).alias("gw")))
    tracks = (keys.groupBy("isrc")
              .agg(*[F.sum(x).alias(x) for x in ("c", "neg", "not_sat", "bad_region", "pk_null", "dup")],
                   F.count(F.lit(1)).alias("groups"), F.min("t0").alias("t0"), F.max("t1").alias("t1"),
                   F.max(F.col("g").cast("int")).alias("g"), F.sum(F.col("gw").cast("int")).alias("gw")))
    total = tracks.agg(
        F.sum("c").alias("n"), F.sum("neg").alias("neg"), F.sum("not_sat").alias("not_sat"),
        F.sum("bad_region").alias("bad_region"), F.sum("pk_null").alias("pk_null"),
        F.sum("dup").alias("dup"), F.sum("groups").alias("groups"),
        F.count_if(F.col("t0") != F.col("t1")).alias("multi_track"), F.count(F.lit(1)).alias("isrcs"),
        F.count_if((F.col("g") == 1) & (F.col("gw") <= min_weeks)).alias("short"),
        F.count_if(F.col("g") == 1).alias("global_isrcs"))
    rules = [("streams_non_negative", "neg", "n"), ("week_ending_saturday", "not_sat", "n"),
             ("region_allowed", "bad_region", "n"), ("pk_not_null", "pk_null", "n"),
             ("isrc_single_track", "multi_track", "isrcs"), ("min_history", "short", "global_isrcs"),
             ("pk_unique", "dup", "groups")]
    return total.select(F.explode(F.array(*[
        F.struct(*_row(rule, F.coalesce(F.col(failed), F.lit(0)), F.coalesce(F.col(tot), F.lit(0))))
        for rule, failed, tot in rules])).alias("r")).select("r.*")


def assert_quality(report: DataFrame) -> DataFrame:
    """Strict mode: raise inside the job when any rule fails."""
    return report.withColumn(
        "failed", F.when(F.col("failed") == 0, F.col("failed"))
        .otherwise(F.raise_error(F.concat(F.lit("quality rule failed: "), F.col("rule"))).cast("bigint")))
