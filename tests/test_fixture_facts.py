"""The facts FIXTURES.md states for sf0.01, recomputed through the package."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterwise.functions.timeutil import diff_units
from meterwise.operators.attribution import attribute
from meterwise.operators.features import training_features
from meterwise.operators.forecast import fit_trend, forecast
from meterwise.sources.logs import usage_logs
from meterwise.sources.weekly import weekly_input
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def logs(spark):
    return usage_logs(spark, SF_MID)


def test_log_volumes(logs):
    assert logs.qh.count() == 10_000
    meter = logs.meter.groupBy("warehouse_name").count().collect()
    assert {r["warehouse_name"]: r["count"] for r in meter} == {"FORECAST_WH": 720, "AUX_WH": 694}
    assert logs.load.count() == 1_414
    assert logs.billing.count() == 30


def test_zero_hour_boundary_rows(logs):
    n = logs.meter.filter(diff_units("hour", "start_time", "end_time") == 0).count()
    assert n == 112


def test_fan_out_attribution(logs):
    real = logs.meter.filter(F.col("warehouse_name") == "FORECAST_WH").agg(F.sum("credits_used")).first()[0]
    attributed = attribute(logs.qh, logs.meter).agg(F.sum("credits_used")).first()[0]
    assert round(float(real), 2) == 614.47
    assert round(float(attributed), 2) == 5677.60


def test_prorated_attribution_conserves_credits(logs):
    """The prorated option hands out each hour's credits exactly once."""
    everything = attribute(logs.qh, logs.meter, success_only=False, prorate=True)
    total = everything.agg(F.sum("credits_used")).first()[0]
    assert total == pytest.approx(614.47, abs=0.01)


def test_weekly_volumes(spark):
    weekly = weekly_input(spark, SF_MID)
    counts = {r["g"]: r["count"] for r in
              weekly.groupBy((F.col("region") == "Global").alias("g")).count().collect()}
    assert counts == {True: 8_927, False: 32_036}
    assert weekly.filter(F.col("region") == "Global").select("isrc").distinct().count() == 25
    assert training_features(weekly).count() == 974


def test_forecast_rows(spark):
    g = weekly_input(spark, SF_MID, region="Global")
    fc = forecast(fit_trend(g, series_cols=["isrc"]))
    assert fc.count() == 300
    bad = fc.filter((F.col("lower_bound") > F.col("forecast")) | (F.col("forecast") > F.col("upper_bound"))).count()
    assert bad == 0
