"""The batch jobs end to end (in-process, on the test session)."""

from __future__ import annotations

import importlib
import os
import sys

from pyspark.sql import functions as F

from meterwise.session import scratch_path
from tests.conftest import SF_SMALL

JOBS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "jobs")


def run_job(monkeypatch, name, *args):
    monkeypatch.syspath_prepend(JOBS)
    monkeypatch.setattr(sys, "argv", [name, *args])
    module = importlib.import_module(name)
    return module.main()


def test_prepare_train_score_forecast(spark, monkeypatch):
    out = scratch_path(spark, "jobs")
    assert run_job(monkeypatch, "prepare", "--sf-dir", SF_SMALL, "--out", out) == "OK"
    weekly = spark.read.parquet(f"{out}/weekly_input")
    assert {r["region"] for r in weekly.select("region").distinct().collect()} >= {"Global"}
    assert spark.read.parquet(f"{out}/weekly_quality").count() == 7
    summary = spark.read.parquet(f"{out}/weekly_summary")
    assert summary.count() == weekly.select("region", "week_ending").distinct().count()
    common = ["--sf-dir", SF_SMALL, "--out", out, "--weekly", f"{out}/weekly_input"]
    assert run_job(monkeypatch, "forecast", *common, "--by-track") == "OK"
    fc = spark.read.parquet(f"{out}/forecast_output_trend")
    assert fc.count() == 12 * weekly.filter(F.col("region") == "Global").select("isrc").distinct().count()
    assert run_job(monkeypatch, "train", *common, "--param", "n_estimators=5", "--param", "max_depth=3") == "MODEL_SAVED"
    assert run_job(monkeypatch, "score", *common) == "OK"
    scored = spark.read.parquet(f"{out}/forecast_output_global")
    assert scored.count() == 2 * weekly.filter(F.col("region") == "Global").count()
    assert run_job(monkeypatch, "score", *common, "--region", "NOWHERE") == "NO_ROWS"


def test_usage_reports_job(spark, monkeypatch):
    out = scratch_path(spark, "reports_job")
    assert run_job(monkeypatch, "usage_reports", "--sf-dir", SF_SMALL, "--out", out, "--days", "14") == "OK"
    assert spark.read.parquet(f"{out}/reports/cost_by_workload_path").count() > 0
    assert spark.read.parquet(f"{out}/reports/kpi_status").count() == 5
