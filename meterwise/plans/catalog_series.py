"""Registered weekly-series queries: input, features, quality, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.operators import features as FT
from meterwise.operators import forecast as FC
from meterwise.operators.quality import quality_report
from meterwise.plans.catalog import register
from meterwise.plans.oracle import with_ctes
from meterwise.sources.weekly import weekly_input

LOG_DIGITS = 6


def _r(df, *cols):
    """Round float columns that come from transcendental functions."""
    for c in cols:
        df = df.withColumn(c, F.round(c, LOG_DIGITS))
    return df


register("weekly_input", "S1 S2 fixture", with_ctes("SELECT * FROM weekly_input", "weekly_input"))(
    lambda spark, d: weekly_input(spark, d))

register("weekly_global", "S1", with_ctes("SELECT * FROM weekly_input WHERE region = 'Global'", "weekly_input"))(
    lambda spark, d: weekly_input(spark, d, region="Global"))

register("weekly_summary", "A22", with_ctes("""
SELECT region, week_ending, cast(sum(streams) AS bigint) AS total_streams, count(DISTINCT isrc) AS track_count
FROM weekly_input GROUP BY region, week_ending""", "weekly_input"))(
    lambda spark, d: FT.weekly_summary(weekly_input(spark, d)))

register("qualifying_tracks", "J3", with_ctes("""
SELECT isrc, count(DISTINCT week_ending) AS week_count FROM weekly_input WHERE region = 'Global'
GROUP BY isrc HAVING count(DISTINCT week_ending) > 10""", "weekly_input"))(
    lambda spark, d: FT.qualifying(weekly_input(spark, d, region="Global")))

_WSR = "cast(floor(date_diff('day', release_date, week_ending) / 7) AS bigint)"
_CAL = f"""week_since_release * week_since_release AS week_since_release_sq,
  week_since_release * week_since_release * week_since_release AS week_since_release_cb,
  cast(weekofyear(week_ending) AS int) AS week_of_year,
  CASE WHEN week_since_release <= {P.FIRST_WEEKS_FLAG} THEN 1 ELSE 0 END AS is_first_4_weeks"""

_TRAIN_COLS = ["isrc", "week_ending", "streams", "week_since_release", "last_week_streams", "avg_streams_to_date",
               "pct_change", "week_since_release_sq", "week_since_release_cb", "week_of_year", "is_first_4_weeks",
               "log_streams", "log_last_week_streams", "log_avg_streams_to_date"]

register("training_features", "F1 W2 W3 W5 J3", with_ctes(f"""
SELECT isrc, week_ending, streams, week_since_release, last_week_streams, avg_streams_to_date, pct_change,
  {_CAL},
  round(ln(1 + streams), 6) AS log_streams,
  round(ln(1 + last_week_streams), 6) AS log_last_week_streams,
  round(ln(1 + avg_streams_to_date), 6) AS log_avg_streams_to_date
FROM (
  SELECT isrc, week_ending, streams, week_since_release,
    coalesce(lag(streams) OVER w, 0) AS last_week_streams,
    avg(streams) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS avg_streams_to_date,
    coalesce((streams - lag(streams) OVER w) / nullif(lag(streams) OVER w, 0), 0) AS pct_change
  FROM (SELECT isrc, week_ending, release_date, streams, {_WSR} AS week_since_release
        FROM weekly_input WHERE region = 'Global' AND isrc IN (
          SELECT isrc FROM weekly_input WHERE region = 'Global' GROUP BY isrc HAVING count(DISTINCT week_ending) > 10)) b
  WHERE week_since_release < 52
  WINDOW w AS (PARTITION BY isrc ORDER BY week_since_release)) f""", "weekly_input"))(
    lambda spark, d: _r(FT.training_features(weekly_input(spark, d, region="Global")).select(*_TRAIN_COLS),
                        "log_streams", "log_last_week_streams", "log_avg_streams_to_date"))

_SCORE_COLS = ["region", "isrc", "display_artist", "track", "release_date", "week_ending", "streams",
               "week_since_release", "last_week_streams", "avg_streams_to_date", "last_week_pct_change",
               "log_last_week_streams", "log_avg_streams_to_date", "week_since_release_sq", "week_since_release_cb",
               "week_of_year", "is_first_4_weeks"]

register("scoring_features", "F2 W2 W3 W5", with_ctes(f"""
SELECT region, isrc, display_artist, track, release_date, week_ending, streams, week_since_release,
  last_week_streams, avg_streams_to_date, last_week_pct_change,
  round(ln(1 + last_week_streams), 6) AS log_last_week_streams,
  round(ln(1 + avg_streams_to_date), 6) AS log_avg_streams_to_date,
  {_CAL}
FROM (
  SELECT *, {_WSR} AS week_since_release,
    coalesce(lag(streams) OVER w, 0) AS last_week_streams,
    avg(streams) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS avg_streams_to_date,
    coalesce((streams - lag(streams) OVER w) / nullif(lag(streams) OVER w, 0), 0) AS last_week_pct_change
  FROM weekly_input WHERE region = 'Global'
  WINDOW w AS (PARTITION BY isrc ORDER BY week_ending)) f""", "weekly_input"))(
    lambda spark, d: _r(FT.scoring_features(weekly_input(spark, d, region="Global")).select(*_SCORE_COLS),
                        "log_last_week_streams", "log_avg_streams_to_date"))

_FV_SQL = """
SELECT isrc, week_ending,
  avg(streams) OVER (PARTITION BY isrc ORDER BY week_ending ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS avg_streams_to_date,
  cast(sum(streams) OVER (PARTITION BY isrc ORDER BY week_ending ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS bigint)
    AS streams_last_4_weeks
FROM weekly_input WHERE region = 'Global'"""

register("stream_features", "F3 W3 W4", with_ctes(_FV_SQL, "weekly_input"))(
    lambda spark, d: FT.stream_features(weekly_input(spark, d, region="Global")))

ASOF_REGION = "EUROPE"
ASOF_LAG_DAYS = 10


def _asof(spark, d):
    weekly = weekly_input(spark, d)
    spine = (weekly.filter(F.col("region") == ASOF_REGION)
             .select("isrc", F.date_add("week_ending", ASOF_LAG_DAYS).alias("ts")))
    return FT.features_asof(spine, FT.stream_features(weekly), key="isrc", spine_ts="ts", feature_ts="week_ending")


register("features_asof", "J6", with_ctes(f"""
SELECT s.isrc, s.ts, f.week_ending, f.avg_streams_to_date, f.streams_last_4_weeks
FROM (SELECT isrc, week_ending + {ASOF_LAG_DAYS} AS ts FROM weekly_input WHERE region = '{ASOF_REGION}') s
ASOF LEFT JOIN fv f ON s.isrc = f.isrc AND s.ts >= f.week_ending""", "weekly_input",
    extra={"fv": _FV_SQL}))(_asof)

_ALLOWED = ", ".join(f"'{r}'" for r in P.ALLOWED_REGIONS)
QUALITY_SQL = f"""
SELECT 'streams_non_negative' AS rule, count(*) FILTER (WHERE streams < 0) AS failed, count(*) AS total FROM weekly_input
UNION ALL SELECT 'week_ending_saturday', count(*) FILTER (WHERE dayofweek(week_ending) != 6), count(*) FROM weekly_input
UNION ALL SELECT 'region_allowed', count(*) FILTER (WHERE NOT coalesce(region IN ({_ALLOWED}), false)), count(*)
  FROM weekly_input
UNION ALL SELECT 'pk_not_null', count(*) FILTER (WHERE region IS NULL OR isrc IS NULL OR week_ending IS NULL), count(*)
  FROM weekly_input
UNION ALL SELECT 'isrc_single_track', count(*) FILTER (WHERE names > 1), count(*)
  FROM (SELECT isrc, count(DISTINCT track) AS names FROM weekly_input GROUP BY isrc) t
UNION ALL SELECT 'min_history', count(*) FILTER (WHERE weeks <= {P.MIN_HISTORY_WEEKS}), count(*)
  FROM (SELECT isrc, count(DISTINCT week_ending) AS weeks FROM weekly_input WHERE region = 'Global' GROUP BY isrc) t
UNION ALL SELECT 'pk_unique', count(*) FILTER (WHERE c > 1), count(*)
  FROM (SELECT region, isrc, week_ending, count(*) AS c FROM weekly_input GROUP BY region, isrc, week_ending) t"""
register("quality_report", "Q1 Q2 Q3 Q4 Q5 Q6", with_ctes(QUALITY_SQL,
    "weekly_input"))(lambda spark, d: quality_report(weekly_input(spark, d)))


def _forecast_sql(series_expr: str, seasonal: bool = False) -> str:
    """Oracle of fit_trend + forecast: least squares by definition, deviations from the means in a second pass."""
    season = "coalesce(i.s, 0.0::double)" if seasonal else "0.0::double"
    index_join = "LEFT JOIN idx i ON f.series = i.series AND weekofyear(f.ts) = i.woy" if seasonal else ""
    return f"""
WITH obs AS (SELECT {series_expr} AS series, week_ending AS ts, sum(streams) AS y
             FROM weekly_input WHERE region = 'Global' GROUP BY 1, 2),
o2 AS (SELECT series, ts, y, cast(floor(date_diff('day', DATE '1970-01-01', ts) / 7) AS bigint) AS t FROM obs),
m AS (SELECT series, count(*) AS n, sum(cast(t AS double)) AS sx, sum(cast(y AS double)) AS sy,
        max(ts) AS last_ts, max(t) AS last_t, min(t) AS first_t
      FROM o2 GROUP BY series),
c AS (SELECT m.*, d.cxx, d.cxy, d.cyy FROM m JOIN (
        SELECT o2.series, sum((t - sx / n) * (t - sx / n)) AS cxx, sum((t - sx / n) * (cast(y AS double) - sy / n)) AS cxy,
          sum((cast(y AS double) - sy / n) * (cast(y AS double) - sy / n)) AS cyy
        FROM o2 JOIN m ON o2.series = m.series GROUP BY o2.series) d ON m.series = d.series),
p AS (SELECT series, n, last_ts, last_t, first_t, sx / n AS tbar, sy / n AS ybar, cxx,
        CASE WHEN n >= 3 AND cxx > 0 THEN cxy / cxx END AS slope,
        CASE WHEN n >= 3 AND cxx > 0 THEN greatest(0.0::double, (cyy - cxy * cxy / cxx) / (n - 2)) END AS sigma2
      FROM c),
idx AS (SELECT w.series, w.woy,
          w.wsy / w.wn - (p.ybar + coalesce(p.slope, 0.0::double) * (w.wsx / w.wn - p.tbar)) AS s
        FROM (SELECT series, cast(weekofyear(ts) AS int) AS woy, count(*) AS wn, sum(cast(t AS double)) AS wsx,
                sum(cast(y AS double)) AS wsy FROM o2 GROUP BY 1, 2) w
        JOIN p ON w.series = p.series WHERE p.last_t - p.first_t >= 104),
f AS (SELECT p.*, r.horizon, cast(p.last_t + r.horizon AS double) - p.tbar AS dt,
        p.last_ts + cast(7 * r.horizon AS int) AS ts
      FROM p, range(1, {P.FORECAST_HORIZON + 1}) AS r(horizon)),
y AS (SELECT f.*, CASE WHEN slope IS NULL THEN ybar ELSE ybar + slope * dt END + {season} AS yhat,
        sqrt(sigma2 * (1.0::double + 1.0::double / n + dt * dt / cxx)) AS se
      FROM f {index_join})
SELECT series, ts, cast(horizon AS int) AS horizon, round(yhat, 4) AS forecast,
  round(yhat - {P.Z_95} * se, 4) AS lower_bound, round(yhat + {P.Z_95} * se, 4) AS upper_bound
FROM y"""


register("forecast_trend", "F10 F11", with_ctes(_forecast_sql("'Global'"), "weekly_input"))(
    lambda spark, d: FC.forecast(FC.fit_trend(weekly_input(spark, d, region="Global"))))

register("forecast_by_track", "F10 F11", with_ctes(_forecast_sql("isrc"), "weekly_input"))(
    lambda spark, d: FC.forecast(FC.fit_trend(weekly_input(spark, d, region="Global"), series_cols=["isrc"])))

register("forecast_seasonal", "F10 F11 (week-of-year index)", with_ctes(_forecast_sql("isrc", seasonal=True),
                                                                        "weekly_input"))(
    lambda spark, d: FC.forecast(FC.fit_trend(weekly_input(spark, d, region="Global"), series_cols=["isrc"],
                                              seasonal=True)))

register("linear_fit", "F9", with_ctes(f"""
SELECT isrc, n, round(cxy / nullif(cxx, 0), 6) AS slope,
  round(sy / n - cxy / nullif(cxx, 0) * sx / n, 6) AS intercept,
  round(cxy * cxy / nullif(cxx * cyy, 0), 6) AS r2
FROM (
  SELECT *, sxx - sx * sx / n AS cxx, sxy - sx * sy / n AS cxy, syy - sy * sy / n AS cyy
  FROM (
    SELECT isrc, count(*) AS n, sum(cast(x AS double)) AS sx, sum(cast(streams AS double)) AS sy,
      sum(cast(x AS double) * cast(x AS double)) AS sxx, sum(cast(x AS double) * cast(streams AS double)) AS sxy,
      sum(cast(streams AS double) * cast(streams AS double)) AS syy
    FROM (SELECT isrc, streams, {_WSR} AS x FROM weekly_input WHERE region = 'Global') b
    GROUP BY isrc) m) c""", "weekly_input"))(
    lambda spark, d: FC.linear_fit(
        weekly_input(spark, d, region="Global").withColumn("x", FT.week_since_release()),
        x="x", y="streams", group_cols=["isrc"]))
