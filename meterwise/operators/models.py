"""Boosted-tree training and scoring on MLlib, and the placeholder linear model.

Training is distributed: executors build the split histograms of each tree
from their partitions, the driver only coordinates rounds.  Nothing is
converted to pandas.  Scoring is ``model.transform`` -- a per-row native
prediction -- with each row emitting its observed and scored halves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.operators.features import FEATURE_COLUMNS, TARGET_COLUMN
from meterwise.schemas import SCORED_OUTPUT, conform

NO_DATA = "NO_DATA"
NO_ROWS = "NO_ROWS"


def gbt_estimator(params: dict | None = None, *, features_col: str = "features", label_col: str = TARGET_COLUMN,
                  checkpoint_interval: int = 10) -> GBTRegressor:
    """Map the boosted-tree settings onto ``GBTRegressor``.

    n_estimators -> maxIter, max_depth -> maxDepth, learning_rate -> stepSize,
    subsample -> subsamplingRate, colsample_bytree -> featureSubsetStrategy
    (MLlib samples per node, not per tree), random_state -> seed, squared
    error -> lossType.  Deep trees cache node ids per instance (MLlib's advice
    for deep trees; on shallow ones it only adds a persist per round) and
    checkpoint every ``checkpoint_interval`` rounds to spark.checkpoint.dir,
    which keeps the lineage of long boosting runs short.
    """
    p = dict(P.GBT_PARAMS)
    p.update(params or {})
    deep = int(p["max_depth"]) >= 6
    return GBTRegressor(
        featuresCol=features_col, labelCol=label_col, predictionCol="prediction",
        maxIter=int(p["n_estimators"]), maxDepth=int(p["max_depth"]), stepSize=float(p["learning_rate"]),
        subsamplingRate=float(p["subsample"]), featureSubsetStrategy=str(p["colsample_bytree"]),
        lossType="squared", maxBins=int(p.get("max_bins", 32)), seed=int(p["random_state"]),
        cacheNodeIds=deep, checkpointInterval=checkpoint_interval)


def train_gbt(features: DataFrame, *, cols: Sequence[str] = FEATURE_COLUMNS, target: str = TARGET_COLUMN,
              params: dict | None = None) -> PipelineModel | str:
    """fit assembler + boosted trees on the log target; NO_DATA when empty."""
    # The fit passes over its input several times (metadata, split candidates,
    # boosting rounds).  The training set (one row per track-week) is written
    # once to the shared checkpoint folder: that cuts the lineage, survives
    # executor loss, and keeps the partitioning AQE chose for the data.  (A
    # persisted plan keeps the raw shuffle partition count -- hundreds of
    # near-empty partitions that every tree level would then visit.)
    data = (features.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(target).cast("double"))
            .checkpoint(eager=True))
    if data.isEmpty():
        return NO_DATA
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep"),
                            gbt_estimator(params, label_col=target)])
    return pipe.fit(data)


def score_region(model: PipelineModel, features: DataFrame, *, model_file: str = P.MODEL_FILE,
                 cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """every input row twice -- observed (no prediction, flag 0) and scored (flag 1).

    These are in-sample scores of the rows given, not future weeks.  An empty
    input gives an empty result; the scoring job reports it as NO_ROWS.
    """
    base = features.select(*[F.col(c).cast("double").alias(c) for c in cols],
                           "region", "isrc", "display_artist", "track", "release_date", "week_ending", "streams")
    # One pass: every scored row emits its observed twin and itself, so the
    # features are derived and the model evaluated once per input row.
    halves = F.array(
        F.struct(F.lit(None).cast("double").alias("streams_predicted"), F.lit(0).alias("is_forecast")),
        F.struct(F.expm1("prediction").alias("streams_predicted"), F.lit(1).alias("is_forecast")))
    out = (model.transform(base)
           .select("region", "isrc", "display_artist", "track", "release_date", "week_ending",
                   F.col("streams").alias("streams_actual"), F.explode(halves).alias("h"))
           .select("region", "isrc", "display_artist", "track", "release_date", "week_ending", "streams_actual",
                   "h.streams_predicted", "h.is_forecast", F.lit(model_file).alias("model_file")))
    return conform(out, SCORED_OUTPUT)


def train_linear(df: DataFrame, *, x: str, y: str) -> PipelineModel:
    """F9 (model form): one-feature linear regression as an MLlib pipeline."""
    data = df.select(F.col(x).cast("double").alias(x), F.col(y).cast("double").alias("label"))
    return Pipeline(stages=[VectorAssembler(inputCols=[x], outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol="label", regParam=0.0)]).fit(data)


def save_model(model: PipelineModel, path: str) -> str:
    """Write the fitted pipeline (overwrite) and return its path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
