"""Closed-form trend forecasts with prediction intervals.

Fitting is one aggregation per series (count, means and centred co-moments);
forecasting multiplies each fitted series by its horizons with
``explode(sequence(1, h))`` -- no shuffle, no per-series Python.

Model, per series: ordinary least squares of y on t, where t counts periods
(``period_days``) since 1970-01-01.  Forecast at t_h:

    yhat = ybar + b (t_h - tbar),  b = cxy / cxx
    s2   = (cyy - cxy^2 / cxx) / (n - 2)
    se   = sqrt(s2 (1 + 1/n + (t_h - tbar)^2 / cxx))
    bounds = yhat -/+ z se

With n < 3 or cxx = 0 the forecast is the series mean and the bounds are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.schemas import FORECAST_OUTPUT, conform


def period_index(ts: str = "week_ending", period_days: int = 7) -> F.Column:
    return F.floor(F.datediff(F.col(ts), F.lit("1970-01-01").cast("date")) / period_days).cast("bigint")


def moments(df: DataFrame, x: str, y: str, group_cols: Sequence[str], *extra) -> DataFrame:
    """n, means and centred sums of squares and products of the rows that have both x and y.

    The built-in co-moment aggregates keep centred partial sums and merge them
    pairwise, so large offsets of x or y cancel nothing, however rows are partitioned.
    """
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*group_cols).agg(
        F.regr_count(yd, xd).alias("n"), F.regr_avgx(yd, xd).alias("tbar"), F.regr_avgy(yd, xd).alias("ybar"),
        F.regr_sxx(yd, xd).alias("cxx"), F.regr_sxy(yd, xd).alias("cxy"), F.regr_syy(yd, xd).alias("cyy"), *extra)


def _merged(parts: DataFrame, group_cols: Sequence[str], keep: str, *extra) -> DataFrame:
    """Moments of whole groups from those of their parts (a bounded number per group, told apart by ``keep``)."""
    part = F.struct(keep, "n", "tbar", "ybar", "cxx", "cxy", "cyy")
    rows = parts.groupBy(*group_cols).agg(F.sort_array(F.collect_list(F.when(F.col("n") > 0, part))).alias("_parts"), *extra)

    def total(term):
        return F.aggregate("_parts", F.lit(0.0), lambda acc, w: acc + term(w))

    rows = rows.withColumn("n", F.aggregate("_parts", F.lit(0).cast("bigint"), lambda acc, w: acc + w["n"]))
    count = F.nullif(F.col("n"), F.lit(0).cast("bigint"))
    rows = rows.withColumns({"tbar": total(lambda w: w["n"] * w["tbar"]) / count, "ybar": total(lambda w: w["n"] * w["ybar"]) / count})

    def off(w, mean):
        return w[mean] - F.col(mean)

    return rows.withColumns({
        "cxx": total(lambda w: w["cxx"] + w["n"] * off(w, "tbar") * off(w, "tbar")),
        "cxy": total(lambda w: w["cxy"] + w["n"] * off(w, "tbar") * off(w, "ybar")),
        "cyy": total(lambda w: w["cyy"] + w["n"] * off(w, "ybar") * off(w, "ybar"))})


def fit_trend(df: DataFrame, *, ts: str = "week_ending", y: str = "streams", series_cols: Sequence[str] = (),
              series_name: str = "Global", duplicates: str = "sum", period_days: int = 7,
              seasonal: bool = False, min_season_periods: int = 104) -> DataFrame:
    """one model row per series (n, means, centered sums, slope, variance, last period).

    Rows sharing a timestamp within a series are combined first (``sum`` or
    ``avg``), so several tracks under one date make one observation.  With
    ``seasonal``, series spanning at least ``min_season_periods`` periods get
    an additive week-of-year index: the mean trend residual per ISO week,
    kept in the model row as a map (at most 53 entries per series).
    """
    combine = F.sum if duplicates == "sum" else F.avg
    series = (F.concat_ws("|", *[F.col(c).cast("string") for c in series_cols]) if series_cols
              else F.lit(series_name))
    obs = (df.groupBy(series.alias("series"), F.col(ts).alias("ts"))
           .agg(combine(y).alias("y"))
           .withColumn("t", period_index("ts", period_days)))
    ends = [F.max("ts").alias("last_ts"), F.max("t").alias("last_t"), F.min("t").alias("first_t")]
    if seasonal:
        # One pass: moments per (series, ISO week), then per series.  The week
        # partials (<= 53 per series) ride along as an array, from which the
        # seasonal index -- the mean trend residual per week -- is computed
        # with higher-order functions: no join back to the observations.
        weekly = moments(obs, "t", "y", ["series", F.weekofyear("ts").alias("woy")], *ends)
        fitted = _merged(weekly, ["series"], "woy", F.max("last_ts").alias("last_ts"), F.max("last_t").alias("last_t"),
                         F.min("first_t").alias("first_t"))
    else:
        fitted = moments(obs, "t", "y", ["series"], *ends)
    n = F.col("n").cast("double")
    ok = (F.col("n") >= 3) & (F.col("cxx") > 0)
    model = fitted.select(
        "series", "n", "last_ts", "last_t", "first_t", "tbar", "ybar", "cxx", "cxy", "cyy",
        F.when(ok, F.col("cxy") / F.col("cxx")).alias("slope"),
        F.when(ok, F.greatest(F.lit(0.0), (F.col("cyy") - F.col("cxy") * F.col("cxy") / F.col("cxx"))
                                / (n - 2))).alias("sigma2"),
        *([F.col("_parts")] if seasonal else []))
    if not seasonal:
        return model.withColumn("season", F.lit(None).cast("map<int,double>"))
    slope = F.coalesce(F.col("slope"), F.lit(0.0))

    def residual(w):
        # mean over the week of y - (ybar + slope (t - tbar))
        return F.struct(w["woy"].alias("key"),
                        (w["ybar"] - (F.col("ybar") + slope * (w["tbar"] - F.col("tbar")))).alias("value"))

    season = F.when(F.col("last_t") - F.col("first_t") >= min_season_periods,
                    F.map_from_entries(F.transform("_parts", residual)))
    return model.withColumn("season", season).drop("_parts")


def forecast(model: DataFrame, *, periods: int = P.FORECAST_HORIZON, level_z: float = P.Z_95,
             level: float | None = None, period_days: int = 7, digits: int | None = 4) -> DataFrame:
    """``periods`` future periods per series with lower and upper bounds.

    ``level`` (between 0 and 1) states the share of outcomes the bounds shall
    hold; without it they lie ``level_z`` standard errors off.
    """
    if level is not None:
        level_z = NormalDist().inv_cdf(0.5 + level / 2)
    h = F.col("horizon")
    dt = (F.col("last_t") + h).cast("double") - F.col("tbar")
    trend = F.when(F.col("slope").isNull(), F.col("ybar")).otherwise(F.col("ybar") + F.col("slope") * dt)
    woy = F.weekofyear(F.date_add("last_ts", h * period_days))
    yhat = trend + F.coalesce(F.try_element_at("season", woy), F.lit(0.0))
    se = F.sqrt(F.col("sigma2") * (F.lit(1.0) + F.lit(1.0) / F.col("n") + dt * dt / F.col("cxx")))
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    out = (model.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(periods))))
           .select("series", F.date_add("last_ts", h * period_days).alias("ts"), "horizon",
                   r(yhat).alias("forecast"),
                   r(yhat - F.lit(level_z) * se).alias("lower_bound"),
                   r(yhat + F.lit(level_z) * se).alias("upper_bound")))
    return conform(out, FORECAST_OUTPUT)


def linear_fit(df: DataFrame, *, x: str, y: str, group_cols: Sequence[str], digits: int = 6) -> DataFrame:
    """per-group OLS slope, intercept and R^2 from the same moment sums."""
    m = moments(df, x, y, group_cols)
    slope = F.col("cxy") / F.nullif(F.col("cxx"), F.lit(0.0))
    r2 = F.col("cxy") * F.col("cxy") / F.nullif(F.col("cxx") * F.col("cyy"), F.lit(0.0))
    return m.select(*group_cols, "n",
                    F.round(slope, digits).alias("slope"),
                    F.round(F.col("ybar") - slope * F.col("tbar"), digits).alias("intercept"),
                    F.round(r2, digits).alias("r2"))


def to_reference_shape(fc: DataFrame, target_name: str = "streams") -> DataFrame:
    """Project our forecast rows onto the wider forecast-output scaffold."""
    return fc.select(
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.lit(None).cast("double").alias("target_value"),
        F.lit(target_name).alias("target_name"),
        F.col("forecast").alias("forecasted_value"), "lower_bound", "upper_bound",
        F.col("horizon"), F.col("series").alias("metric"))
