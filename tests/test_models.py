"""Boosted trees, scoring shape, model and feature-view registries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterwise.operators import features as FT
from meterwise.operators.models import load_model, save_model, score_region, train_gbt, train_linear
from meterwise.operators.registry import FeatureViewRegistry, ModelRegistry
from meterwise.session import scratch_path
from meterwise.sources.weekly import weekly_input
from tests.conftest import SF_MID

QUICK = {"n_estimators": 8, "max_depth": 4}


@pytest.fixture(scope="module")
def weekly(spark):
    return weekly_input(spark, SF_MID, region="Global").cache()


@pytest.fixture(scope="module")
def model(weekly):
    return train_gbt(FT.training_features(weekly), params=QUICK)


def test_gbt_beats_mean_baseline(model, weekly):
    feats = FT.training_features(weekly)
    pred = model.transform(feats.select(*[F.col(c).cast("double") for c in FT.FEATURE_COLUMNS],
                                        F.col("log_streams")))
    mean = feats.agg(F.avg("log_streams")).first()[0]
    r = pred.agg(F.avg((F.col("prediction") - F.col("log_streams")) ** 2).alias("mse"),
                 F.avg((F.lit(mean) - F.col("log_streams")) ** 2).alias("base")).first()
    assert r["mse"] < r["base"]


def test_scored_output_shape(model, weekly):
    feats = FT.scoring_features(weekly)
    out = score_region(model, feats)
    n = feats.count()
    assert out.count() == 2 * n
    halves = {r["is_forecast"]: (r["n"], r["nulls"]) for r in out.groupBy("is_forecast").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("streams_predicted").isNull()).alias("nulls")).collect()}
    assert halves == {0: (n, n), 1: (n, 0)}


def test_no_data_status(spark, weekly):
    empty = FT.training_features(weekly.filter(F.lit(False)))
    assert train_gbt(empty, params=QUICK) == "NO_DATA"


def test_registry_round_trip(spark, model, weekly):
    reg = ModelRegistry(spark, scratch_path(spark, "registry_test"))
    reg.log_model(model, "m", "v1", comment="test")
    reg.log_model(model, "m", "v1", comment="again")  # re-log replaces the row
    assert reg.entries().count() == 1
    loaded = reg.get("m", "v1")
    feats = FT.training_features(weekly).select(*[F.col(c).cast("double") for c in FT.FEATURE_COLUMNS])
    a = model.transform(feats).select("prediction").collect()
    b = loaded.transform(feats).select("prediction").collect()
    assert a == b
    reg.drop("m")
    assert reg.entries().count() == 0
    with pytest.raises(KeyError):
        reg.get("m", "v1")


def test_save_load_and_linear(spark, weekly):
    lin = train_linear(weekly.withColumn("x", FT.week_since_release()), x="x", y="streams")
    path = save_model(lin, scratch_path(spark, "lin"))
    assert load_model(path).stages[-1].coefficients == lin.stages[-1].coefficients


def test_feature_view_registry(spark, weekly):
    reg = FeatureViewRegistry(spark, scratch_path(spark, "fv_test"))
    view = reg.register_view(FT.stream_features(weekly), "stream_features", "v1", ["isrc"], "week_ending")
    assert view.count() == reg.read_view("stream_features", "v1").count() == weekly.count()
    assert reg.delete_view("stream_features", "v1")
    assert not reg.delete_view("stream_features", "v1")


def test_empty_scoring_input(model, weekly):
    out = score_region(model, FT.scoring_features(weekly.filter(F.lit(False))))
    assert out.isEmpty()


def test_registered_query_trains_with_full_settings(spark, monkeypatch):
    from meterwise.operators.models import gbt_estimator
    from meterwise.plans import catalog_models

    seen = []
    monkeypatch.setattr(catalog_models, "train_gbt", lambda feats, params=None: seen.append(gbt_estimator(params)) or "STOP")
    with pytest.raises(RuntimeError, match="STOP"):
        catalog_models._gbt_scores(spark, SF_MID)
    assert (seen[0].getMaxIter(), seen[0].getMaxDepth()) == (300, 7)
