"""Boosted multi-horizon forecasts: pairs, conformal bounds, odd histories."""

from __future__ import annotations

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from meterwise.operators import horizon as H

FIRST = dt.date(2020, 1, 4)
SCHEMA = "region string, isrc string, release_date date, week_ending date, streams long"


def weekly_rows(tracks, weeks, seed, noise=0.2, gap=()):
    rng = random.Random(seed)
    rows = []
    for k in range(tracks):
        level = 1000 * (k + 1)
        for w in range(weeks):
            if w not in gap:
                y = level * (1 + 0.3 * math.sin(w / 8)) * math.exp(rng.gauss(0, noise))
                rows.append(("Global", f"T{k}", FIRST, FIRST + dt.timedelta(7 * w), int(y)))
    return rows


def test_pairs_follow_the_calendar(spark):
    rows = weekly_rows(2, 9, 1, gap={4})
    weekly = spark.createDataFrame(rows, SCHEMA)
    at = {(r[1], r[3]): r[4] for r in rows}
    found = H.pairs(H.origins(weekly, periods=3)).collect()
    want = {(t, o, h) for (t, o) in at for h in (1, 2, 3) if (t, o + dt.timedelta(7 * h)) in at}
    assert {(r["isrc"], r["week_ending"], int(r["horizon"])) for r in found} == want and len(found) == len(want)
    for r in found:
        past = [at[k] for k in sorted(at) if k[0] == r["isrc"] and k[1] <= r["week_ending"]]
        level = math.log1p(sum(past[-4:]) / len(past[-4:]))
        y = at[r["isrc"], r["week_ending"] + dt.timedelta(7 * int(r["horizon"]))]
        assert math.isclose(r["log_level"], level) and math.isclose(r["growth"], math.log1p(y) - level, abs_tol=1e-12)
        assert r["target_week"] == r["week_ending"] + dt.timedelta(7 * int(r["horizon"])) and r["age_at_target"] * 7 == (r["target_week"] - FIRST).days


def test_bounds_cover_future_weeks(spark):
    """Bounds fitted on the first weeks hold about their level of the weeks that follow."""
    rows = weekly_rows(12, 130, 2)
    cut = FIRST + dt.timedelta(7 * 119)
    weekly = spark.createDataFrame(rows, SCHEMA)
    fc = H.forecast_boosted(weekly.where(F.col("week_ending") <= cut), periods=10, level=0.8, params={"n_estimators": 15, "max_depth": 4})
    found = fc.collect()
    assert len(found) == 120 and {(r["series"], r["horizon"], r["ts"]) for r in found} == {
        (f"T{k}", h, cut + dt.timedelta(7 * h)) for k in range(12) for h in range(1, 11)}
    real = {(r[1], r[3]): r[4] for r in rows}
    held = sum(r["lower_bound"] <= real[r["series"], r["ts"]] <= r["upper_bound"] for r in found) / len(found)
    assert 0.65 <= held <= 0.95 and all(r["lower_bound"] <= r["forecast"] <= r["upper_bound"] for r in found)
    mean = sum(abs(math.log(r["forecast"] / real[r["series"], r["ts"]])) for r in found) / len(found)
    assert mean < 0.35


def test_radius_is_the_conformal_rank(spark):
    weekly = spark.createDataFrame(weekly_rows(3, 80, 3), SCHEMA)
    model, radii = H.train_boosted(weekly, periods=2, level=0.9, params={"n_estimators": 5, "max_depth": 3})
    data = H.pairs(H.origins(weekly, periods=2))
    last = data.agg(F.max("target_t")).first()[0]
    held = model.transform(data.where(F.col("t") >= last - 26).select(*[F.col(c).cast("double") for c in H.ORIGIN_COLUMNS], "growth"))
    errors = {}
    for r in held.collect():
        errors.setdefault(int(r["horizon"]), []).append(abs(r["growth"] - r["prediction"]))
    for r in radii.collect():
        e = sorted(errors[r["horizon"]])
        assert r["n_errors"] == len(e) and math.isclose(r["radius"], e[math.ceil((len(e) + 1) * 0.9) - 1], rel_tol=1e-12)


def test_too_little_history(spark):
    short = spark.createDataFrame(weekly_rows(2, 20, 4), SCHEMA)
    assert H.train_boosted(short) == H.NO_DATA and H.forecast_boosted(short).count() == 0
    assert H.forecast_boosted(short.where("false")).columns == ["series", "ts", "horizon", "forecast", "lower_bound", "upper_bound"]
    few = spark.createDataFrame(weekly_rows(1, 45, 5), SCHEMA)  # too few errors for the level at the far horizons
    rows = {r["horizon"]: r for r in H.forecast_boosted(few, level=0.95, params={"n_estimators": 3, "max_depth": 2}).collect()}
    assert len(rows) == 12 and rows[1]["lower_bound"] is not None and rows[12]["lower_bound"] is None
