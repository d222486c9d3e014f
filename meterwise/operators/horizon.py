"""Boosted forecasts of future weeks: one direct multi-horizon model with split-conformal bounds.

Training pairs are (origin week, horizon): what was known of a track at its
origin, and the plays ``horizon`` weeks later.  The horizon is a feature, so one
pooled model serves all of them and nothing is fed back from earlier
predictions.  Pairs are made in one window pass per track: the future of an
origin is a range frame of at most ``periods`` rows, exploded without a join.

Bounds are split-conformal: the last ``calibration_weeks`` weeks are held back,
the model sees only pairs whose target lies before them, and the absolute errors
of the held-back origins, in log units relative to the recent level, give one
radius per horizon.  The radius is the ceil((n + 1) level)-th smallest error, an
exact order statistic found by distributed selection; with too few errors for
the level the bounds are null.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.operators.features import GLOBAL, week_since_release
from meterwise.operators.forecast import period_index
from meterwise.operators.models import NO_DATA, gbt_estimator
from meterwise.operators.selection import select_ranks
from meterwise.schemas import FORECAST_OUTPUT, conform

#: What is known at an origin, and of the target week.
ORIGIN_COLUMNS = ["log_level", "log_last", "log_lag_1", "log_lag_2", "log_mean_to_date", "weeks_seen", "age_at_target", "horizon", "week_of_year"]
#: Settings of the pooled model; the other boosting settings are those of the scoring model.
BOOSTED_PARAMS = {"n_estimators": 60, "max_depth": 5, "learning_rate": 0.1}


def origins(weekly: DataFrame, *, region: str = GLOBAL, periods: int = P.FORECAST_HORIZON, with_future: bool = True) -> DataFrame:
    """One row per track and week: what is known then, and (``with_future``) the later weeks as an array of (t, streams).

    Windows are partitioned by track; a track has one row per calendar week.
    A level is the mean of the last four rows; missing lags repeat the last value.
    """
    by_track = Window.partitionBy("isrc").orderBy("t")
    recent, so_far = by_track.rowsBetween(-3, 0), by_track.rowsBetween(Window.unboundedPreceding, 0)
    rows = (weekly.filter(F.col("region") == region)
            .groupBy("isrc", "week_ending").agg(F.sum("streams").alias("streams"), F.min("release_date").alias("release_date"))
            .withColumn("t", period_index("week_ending")))
    known = rows.select(
        "isrc", "week_ending", "t", "streams",
        F.log1p(F.avg("streams").over(recent)).alias("log_level"), F.log1p("streams").alias("log_last"),
        *(F.log1p(F.coalesce(F.lag("streams", k).over(by_track), F.col("streams"))).alias(f"log_lag_{k}") for k in (1, 2)),
        F.log1p(F.avg("streams").over(so_far)).alias("log_mean_to_date"), F.count(F.lit(1)).over(so_far).cast("double").alias("weeks_seen"),
        week_since_release().cast("double").alias("age"),
        F.max("t").over(Window.partitionBy("isrc")).alias("last_t"),
        *([F.collect_list(F.struct("t", "streams")).over(by_track.rangeBetween(1, periods)).alias("future")] if with_future else []))
    return known


def _at(horizon: Column) -> list[Column]:
    target = F.date_add("week_ending", (horizon * 7).cast("int"))
    return [horizon.cast("double").alias("horizon"), (F.col("age") + horizon).alias("age_at_target"),
            F.weekofyear(target).cast("double").alias("week_of_year"), target.alias("target_week")]


def pairs(known: DataFrame) -> DataFrame:
    """(origin, horizon) rows with the target as log growth over the recent level."""
    return (known.withColumn("f", F.explode("future")).withColumn("h", (F.col("f.t") - F.col("t")).cast("int"))
            .select("*", *_at(F.col("h"))).withColumn("growth", F.log1p("f.streams") - F.col("log_level"))
            .select("isrc", "week_ending", "target_week", "t", F.col("f.t").alias("target_t"), *ORIGIN_COLUMNS, "growth"))


def train_boosted(weekly: DataFrame, *, region: str = GLOBAL, periods: int = P.FORECAST_HORIZON, level: float = 0.95,
                  calibration_weeks: int = 26, params: dict | None = None) -> tuple[PipelineModel, DataFrame] | str:
    """(model, radii): the pooled model and one row (horizon, n_errors, radius) per horizon; NO_DATA without pairs to train on."""
    known = origins(weekly, region=region, periods=periods)
    data = pairs(known).checkpoint(eager=True)  # read several times by the fit
    last = data.agg(F.max("target_t")).first()[0]
    if last is None:
        return NO_DATA
    cut = last - calibration_weeks
    train = data.where(F.col("target_t") <= cut)
    if train.isEmpty():
        return NO_DATA
    columns = [F.col(c).cast("double").alias(c) for c in ORIGIN_COLUMNS]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=ORIGIN_COLUMNS, outputCol="features", handleInvalid="keep"),
                            gbt_estimator({**BOOSTED_PARAMS, **(params or {})}, label_col="growth")])
    model = pipe.fit(train.select(*columns, "growth").checkpoint(eager=True))
    held = model.transform(data.where(F.col("t") >= cut).select(*columns, "growth"))
    errors = held.select(F.col("horizon").cast("int").alias("horizon"), F.abs(F.col("growth") - F.col("prediction")).alias("error"))
    radii = select_ranks(errors, ["horizon"], "error", {"radius": F.ceil((F.col("n") + 1) * F.lit(float(level))) - 1})
    return model, radii.withColumnRenamed("n", "n_errors")


def forecast_boosted(weekly: DataFrame, *, region: str = GLOBAL, periods: int = P.FORECAST_HORIZON, level: float = 0.95,
                     calibration_weeks: int = 26, params: dict | None = None, digits: int | None = 4) -> DataFrame:
    """F11, boosted tier: ``periods`` future weeks per track after its last one, with bounds at ``level``.

    Without enough history to train on the result is empty.  The radii are one
    row per horizon, so their broadcast is bounded by ``periods``.
    """
    spark = weekly.sparkSession
    trained = train_boosted(weekly, region=region, periods=periods, level=level, calibration_weeks=calibration_weeks, params=params)
    if isinstance(trained, str):
        return spark.createDataFrame([], FORECAST_OUTPUT)
    model, radii = trained
    latest = origins(weekly, region=region, periods=periods, with_future=False).where("t = last_t")
    ahead = (latest.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(periods)))).select("*", *_at(F.col("h")))
             .select("isrc", "h", "target_week", *[F.col(c).cast("double").alias(c) for c in ORIGIN_COLUMNS]))
    scored = model.transform(ahead).join(F.broadcast(radii.select(F.col("horizon").alias("h"), "radius")), "h", "left")
    centre = F.col("log_level") + F.col("prediction")
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)

    def plays(c: Column) -> Column:
        return r(F.greatest(F.lit(0.0), F.expm1(c)))

    out = scored.select(F.col("isrc").alias("series"), F.col("target_week").alias("ts"), F.col("h").alias("horizon"), plays(centre).alias("forecast"),
                        F.when(F.col("radius").isNotNull(), plays(centre - F.col("radius"))).alias("lower_bound"),
                        F.when(F.col("radius").isNotNull(), plays(centre + F.col("radius"))).alias("upper_bound"))
    return conform(out, FORECAST_OUTPUT)
