"""Weekly time-series features, qualification and point-in-time lookup.

Window partitions are one track (``isrc``) within one region.  The weekly
table holds at most one row per (region, track, week), so a partition is
bounded by the number of calendar weeks, however many plays a hot track has:
the skew of the raw data is absorbed by the weekly aggregation upstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwise import params as P

GLOBAL = "Global"

# Feature columns the boosted model is trained and scored on (one contract for both).
FEATURE_COLUMNS = [
    "week_since_release", "week_since_release_sq", "week_since_release_cb", "week_of_year",
    "is_first_4_weeks", "log_last_week_streams", "log_avg_streams_to_date", "last_week_pct_change",
]
TARGET_COLUMN = "log_streams"


def week_since_release(release="release_date", week="week_ending") -> F.Column:
    return F.floor(F.datediff(F.col(week), F.col(release)) / 7).cast("bigint")


def qualifying(weekly: DataFrame, min_weeks: int = P.MIN_HISTORY_WEEKS) -> DataFrame:
    """Tracks with more than ``min_weeks`` distinct weeks."""
    return (weekly.groupBy("isrc").agg(F.count_distinct("week_ending").alias("week_count"))
            .filter(F.col("week_count") > min_weeks))


def _lagged(df: DataFrame, order_col: str, *, leak_free: bool = False) -> DataFrame:
    """Lag, running average and period change over one window spec."""
    w = Window.partitionBy("isrc").orderBy(order_col)
    lag1 = F.lag("streams", 1).over(w)
    frame = w.rowsBetween(Window.unboundedPreceding, -1 if leak_free else Window.currentRow)
    return (df.withColumn("last_week_streams", F.coalesce(lag1, F.lit(0)).cast("bigint"))
              .withColumn("avg_streams_to_date", F.avg("streams").over(frame))
              .withColumn("_chg", (F.col("streams") - lag1) / F.nullif(lag1, F.lit(0))))


def _calendar(df: DataFrame) -> DataFrame:
    wsr = F.col("week_since_release")
    return (df.withColumn("week_since_release_sq", wsr * wsr)
              .withColumn("week_since_release_cb", wsr * wsr * wsr)
              .withColumn("week_of_year", F.weekofyear("week_ending"))
              .withColumn("is_first_4_weeks", F.when(wsr <= P.FIRST_WEEKS_FLAG, 1).otherwise(0)))


def training_features(weekly: DataFrame, *, region: str = GLOBAL, max_age: int = P.MAX_TRAINING_AGE_WEEKS,
                      min_weeks: int = P.MIN_HISTORY_WEEKS, leak_free: bool = False) -> DataFrame:
    """features of qualifying tracks, first ``max_age`` weeks after release.

    The age filter runs before the windows (so lags never reach back past
    it); windows are ordered by week since release.
    """
    # Qualification counts every week of the track (before the age filter).  It
    # is a window over the same (isrc, week_since_release) order the features
    # use, so qualification and features share one shuffle and one sort; the
    # set holds at most one entry per calendar week of one track.
    every = Window.partitionBy("isrc").orderBy("week_since_release").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    df = (weekly.filter(F.col("region") == region)
          .select("isrc", "week_ending", "release_date", "streams")
          .withColumn("week_since_release", week_since_release())
          .withColumn("_weeks", F.size(F.collect_set("week_ending").over(every)))
          .filter(F.col("_weeks") > min_weeks).drop("_weeks")
          .filter(F.col("week_since_release") < max_age))
    df = _lagged(df, "week_since_release", leak_free=leak_free)
    df = df.withColumn("pct_change", F.coalesce(F.col("_chg"), F.lit(0.0))).drop("_chg")
    df = _calendar(df)
    df = (df.withColumn("log_last_week_streams", F.log1p("last_week_streams"))
            .withColumn("log_avg_streams_to_date", F.log1p("avg_streams_to_date"))
            .withColumn("last_week_pct_change", F.col("pct_change"))
            .withColumn("log_streams", F.log1p("streams")))
    return df


def scoring_features(weekly: DataFrame, *, region: str = GLOBAL, leak_free: bool = False) -> DataFrame:
    """features of every row of one region, windows ordered by week."""
    df = (weekly.filter(F.col("region") == region)
          .select("region", "isrc", "display_artist", "track", "release_date", "week_ending", "streams")
          .withColumn("week_since_release", week_since_release()))
    df = _lagged(df, "week_ending", leak_free=leak_free)
    df = df.withColumn("last_week_pct_change", F.coalesce(F.col("_chg"), F.lit(0.0))).drop("_chg")
    df = (df.withColumn("log_last_week_streams", F.log1p("last_week_streams"))
            .withColumn("log_avg_streams_to_date", F.log1p("avg_streams_to_date")))
    return _calendar(df)


def stream_features(weekly: DataFrame, *, region: str = GLOBAL) -> DataFrame:
    """running average and trailing four-row sum per track."""
    w = Window.partitionBy("isrc").orderBy("week_ending")
    return (weekly.filter(F.col("region") == region)
            .select("isrc", "week_ending",
                    F.avg("streams").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                    .alias("avg_streams_to_date"),
                    F.sum("streams").over(w.rowsBetween(-3, Window.currentRow)).cast("bigint")
                    .alias("streams_last_4_weeks")))


def _epoch_days(c) -> F.Column:
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))


def features_asof(spine: DataFrame, features: DataFrame, *, key: str = "isrc", spine_ts: str = "ts",
                  feature_ts: str = "week_ending", bucket_days: int = 7, how: str = "left") -> DataFrame:
    """For each spine row, the latest feature row of its key at or before its time.

    Exact, with no window over the spine and no pairing of all rows of a key:

    1. Each feature row owns ``[ts, next ts)`` of its key (``lead`` over the
       feature rows of one key -- bounded by that key's feature history).
    2. A per-key aggregate of the spine gives the spine's bucket range for
       that key (one row per key, partial aggregation first).
    3. Each interval, clipped to that range, is cut into ``bucket_days``
       buckets; the last, open interval ends at the key's last spine bucket.
    4. One left join of the spine on (key, bucket) plus the interval check.
       A hot key spreads over its buckets; a hot (key, bucket) is split by
       AQE's skew join on the spine side.
    """
    bucket = (lambda c: F.floor(_epoch_days(c) / bucket_days))
    w = Window.partitionBy(key).orderBy(feature_ts)
    fcols = [c for c in features.columns if c != key]
    s = spine.withColumn("_b", bucket(spine_ts))
    span = s.groupBy(F.col(key).alias("_sk")).agg(F.min("_b").alias("_b0"), F.max("_b").alias("_b1"))
    f = features.withColumn("_next", F.lead(feature_ts).over(w))
    lo = F.greatest(bucket(feature_ts), F.col("_b0"))
    hi = F.when(F.col("_next").isNull(), F.col("_b1")).otherwise(F.least(bucket("_next"), F.col("_b1")))
    intervals = (f.join(span, f[key] == span["_sk"], "inner")
                 .filter(lo <= hi)
                 .select(F.col(key).alias("_k"), "_next", *[F.col(c).alias(f"_f_{c}") for c in fcols],
                         F.explode(F.sequence(lo, hi)).alias("_fb")))
    cond = ((s[key] == intervals["_k"]) & (s["_b"] == intervals["_fb"])
            & (intervals[f"_f_{feature_ts}"] <= s[spine_ts])
            & (intervals["_next"].isNull() | (s[spine_ts] < intervals["_next"])))
    return (s.join(intervals, cond, "inner" if how == "inner" else "left")
            .select(*spine.columns, *[F.col(f"_f_{c}").alias(c) for c in fcols]))


def features_asof_views(spine: DataFrame, views: dict[str, tuple[DataFrame, str]], *, key: str = "isrc", spine_ts: str = "ts",
                        bucket_days: int = 91) -> DataFrame:
    """J6 over several feature views: for each spine row, every view's latest row of its key at or before its time.

    One sort-merge over the union of spine and views: within (key, bucket of
    ``bucket_days``) rows are ordered by time and the last row of each view is
    carried along.  What a bucket begins with is the last row of the buckets
    before it, carried over one row per (key, bucket), so a key of any length
    spreads over its buckets and no task holds a whole key.  A view has one row
    per key and time; a spine row at a feature's own time sees it.  Null keys and
    times find nothing.  Columns: the spine's, then ``<view>_<column>``.
    """
    columns = {name: [c for c in df.columns if c != key] for name, (df, _) in views.items()}
    empty = {name: F.lit(None).cast(df.select(F.struct(*columns[name]).alias("s")).schema["s"].dataType) for name, (df, _) in views.items()}
    spine_row = F.struct(*[F.col(c) for c in spine.columns])
    rows = spine.select(F.col(key).alias("_k"), F.col(spine_ts).cast("timestamp").alias("_t"), F.lit(2).alias("_o"), spine_row.alias("_s"),
                        *[empty[n].alias(n) for n in views])
    nothing = F.lit(None).cast(rows.schema["_s"].dataType)
    for name, (df, ts) in views.items():
        rows = rows.unionByName(df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
            F.col(key).alias("_k"), F.col(ts).cast("timestamp").alias("_t"), F.lit(1).alias("_o"), nothing.alias("_s"),
            *[(F.struct(*columns[n]) if n == name else empty[n]).alias(n) for n in views]))
    rows = rows.withColumn("_b", F.floor(_epoch_days("_t") / bucket_days))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    last = (rows.groupBy("_k", "_b").agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_t"))).alias(n) for n in views], F.max("_o").alias("_o"))
            .select("_k", "_b", "_o", *[F.last(n, ignorenulls=True).over(before).alias(n) for n in views]))
    begun = last.filter("_o = 2").select("_k", F.lit(None).cast("timestamp").alias("_t"), F.lit(0).alias("_o"), nothing.alias("_s"), *views, "_b")
    so_far = Window.partitionBy("_k", "_b").orderBy(F.col("_o") != 0, "_t", "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.unionByName(begun).select("_s", "_o", "_k", "_t", *[F.last(n, ignorenulls=True).over(so_far).alias(n) for n in views]).filter("_o = 2")
    known = F.col("_k").isNotNull() & F.col("_t").isNotNull()
    return carried.select("_s.*", *[F.when(known, F.col(n).getField(c)).alias(f"{n}_{c}") for n in views for c in columns[n]])


def weekly_summary(weekly: DataFrame) -> DataFrame:
    """Total plays and distinct tracks per region and week."""
    return (weekly.groupBy("region", "week_ending")
            .agg(F.sum("streams").cast("bigint").alias("total_streams"),
                 F.count_distinct("isrc").alias("track_count")))
