"""Small hand-built frames: nulls, zero guards, boundaries, ties, missing values."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterwise import params as P
from meterwise.functions.cost import estimate_cost, register_sql_estimator
from meterwise.functions.tags import model_path, parse_tag, workload_type
from meterwise.functions.timeutil import diff_units
from meterwise.operators.forecast import fit_trend, forecast, linear_fit
from meterwise.operators.reports import param_value, recent_sessions
from meterwise.sources.logs import cost_params
from meterwise.sources.sinks import set_param, upsert


def test_tag_classification_null_and_order(spark):
    df = spark.createDataFrame([(None,), ("WORKLOAD:TRAINING|PATH:NATIVE",), ("WORKLOAD:DATA_PREP",),
                                ("x",), ("WORKLOAD:INFERENCE|PATH:BOOSTED|SCHEDULED:TRUE",)], "query_tag string")
    rows = df.select(workload_type().alias("w"), model_path().alias("p"),
                     model_path(default=None).alias("pn"), *parse_tag()).collect()
    assert [r["w"] for r in rows] == ["UNTAGGED", "TRAINING", "DATA_PREP", "UNTAGGED", "INFERENCE"]
    assert [r["p"] for r in rows] == ["OTHER", "NATIVE", "OTHER", "OTHER", "BOOSTED"]
    assert [r["pn"] for r in rows] == [None, "NATIVE", None, None, "BOOSTED"]
    assert [r["is_scheduled"] for r in rows] == [False, False, False, False, True]
    assert rows[4]["tag_path"] == "BOOSTED" and rows[0]["tag_workload"] is None


def test_diff_units_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 1, 1))], "a timestamp, b timestamp")
    r = df.select(diff_units("hour", "a", "b").alias("h"), diff_units("minute", "a", "b").alias("m"),
                  diff_units("day", "a", "b").alias("d")).first()
    assert (r["h"], r["m"], r["d"]) == (1, 2, 0)


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=0, max_value=10 ** 6), st.integers(min_value=0, max_value=10 ** 6))
def test_diff_units_property(spark_session_for_hypothesis, a, b):
    base = dt.datetime(2024, 1, 1)
    x, y = base + dt.timedelta(seconds=a), base + dt.timedelta(seconds=a + b)
    r = (spark_session_for_hypothesis.createDataFrame([(x, y)], "a timestamp, b timestamp")
         .select(diff_units("minute", "a", "b").alias("m")).first()["m"])
    assert r == (int(y.timestamp()) // 60) - (int(x.timestamp()) // 60)


@pytest.fixture(scope="module")
def spark_session_for_hypothesis(spark):
    return spark


def test_recent_sessions_zero_hour_guard(spark):
    meter = spark.createDataFrame(
        [("FORECAST_WH", dt.datetime(2024, 1, 30, 10, 5), dt.datetime(2024, 1, 30, 10, 35), 1.5)],
        "warehouse_name string, start_time timestamp, end_time timestamp, credits_used double") \
        .withColumn("start_time", F.col("start_time").cast("timestamp_ntz")) \
        .withColumn("end_time", F.col("end_time").cast("timestamp_ntz")) \
        .withColumn("credits_used", F.col("credits_used").cast("decimal(18,6)"))
    r = recent_sessions(meter).first()
    assert r["duration_minutes"] == 30 and r["credits_per_hour"] is None


def test_missing_parameter_gives_null_estimate(spark):
    params = cost_params(spark)
    df = spark.range(1).select(
        estimate_cost(F.lit(2.0), param_value(params, P.LARGE_CREDITS_PER_HOUR),
                      param_value(params, P.DOLLARS_PER_CREDIT)).alias("e"),
        estimate_cost(F.lit(2.0), param_value(params, P.MEDIUM_CREDITS_PER_HOUR),
                      param_value(params, P.DOLLARS_PER_CREDIT)).alias("m"))
    r = df.first()
    assert r["e"]["estimated_credits"] is None
    assert (r["m"]["estimated_credits"], r["m"]["estimated_dollars"]) == (12.0, 36.0)


def test_sql_estimator_named_arguments(spark):
    register_sql_estimator(spark)
    r = spark.sql("SELECT estimate_wh_cost(runtime_hours => 7.5, credits_per_hour => 6.0, "
                  "dollars_per_credit => 3.0) AS c").first()["c"]
    assert (r["estimated_credits"], r["estimated_dollars"]) == (45.0, 135.0)


def test_upsert_is_idempotent(spark):
    params = cost_params(spark, updated_at=dt.datetime(2024, 1, 1))
    src = spark.createDataFrame([("DOLLARS_PER_CREDIT", 3.5), ("NEW", 1.0)], "param_name string, param_value double")
    once = upsert(params, src, ["param_name"], stamp_col="updated_at", stamp=dt.datetime(2024, 1, 31))
    twice = upsert(once, src, ["param_name"], stamp_col="updated_at", stamp=dt.datetime(2024, 1, 31))
    a = sorted(map(tuple, once.collect()))
    assert a == sorted(map(tuple, twice.collect()))
    vals = {r["param_name"]: r["param_value"] for r in once.collect()}
    assert vals == {"DOLLARS_PER_CREDIT": 3.5, "SP_WH_MEDIUM_CREDITS_PER_HOUR": 6.0, "NEW": 1.0}
    upd = set_param(params, "DOLLARS_PER_CREDIT", 4.0).filter("param_name = 'DOLLARS_PER_CREDIT'").first()
    assert upd["param_value"] == 4.0


def test_single_row_series_forecast(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 6), 10)], "isrc string, week_ending date, streams long")
    fc = forecast(fit_trend(df, series_cols=["isrc"]), periods=3).collect()
    assert len(fc) == 3
    assert all(r["forecast"] == 10.0 and r["lower_bound"] is None for r in fc)
    assert [r["ts"] for r in fc] == [dt.date(2024, 1, 13), dt.date(2024, 1, 20), dt.date(2024, 1, 27)]


def test_exact_line_forecast(spark):
    rows = [("A", dt.date(2024, 1, 6) + dt.timedelta(days=7 * i), 100 + 5 * i) for i in range(6)]
    df = spark.createDataFrame(rows, "isrc string, week_ending date, streams long")
    fc = forecast(fit_trend(df, series_cols=["isrc"]), periods=2).orderBy("horizon").collect()
    assert [r["forecast"] for r in fc] == [130.0, 135.0]
    assert all(r["upper_bound"] == pytest.approx(r["forecast"]) for r in fc)
    lf = linear_fit(df.withColumn("x", F.lit(1) + F.monotonically_increasing_id() * 0), x="x", y="streams",
                    group_cols=["isrc"]).first()
    assert lf["slope"] is None  # constant x


def test_moments_keep_digits_beside_large_offsets(spark):
    """Moments of offset series equal exact fractions, for any partitioning; rows without a value are no observations."""
    from fractions import Fraction

    from meterwise.operators.forecast import moments
    xs, ys = [10**8 + 3 * i for i in range(500)], [10**8 + 40 * i + (i * i) % 97 for i in range(500)]
    xm, ym = Fraction(sum(xs), 500), Fraction(sum(ys), 500)
    want = {"cxx": sum((x - xm) ** 2 for x in xs), "cxy": sum((x - xm) * (y - ym) for x, y in zip(xs, ys)),
            "cyy": sum((y - ym) ** 2 for y in ys)}
    rows = spark.createDataFrame([("A", x, y) for x, y in zip(xs, ys)] + [("A", 5, None)], "s string, x long, y long")
    for parts in (1, 3, 40):
        got = moments(rows.repartition(parts), "x", "y", ["s"]).first()
        assert got["n"] == 500
        assert all(got[k] == pytest.approx(float(v), rel=1e-9) for k, v in want.items())


def test_seasonal_and_plain_fits_agree(spark):
    """Merging week partials gives the moments of the whole series."""
    rows = [(s, dt.date(2020, 1, 4) + dt.timedelta(days=7 * i), 10**8 + (i * 7919) % 1009 + 130 * i)
            for s in "AB" for i in range(160 if s == "A" else 2)]
    df = spark.createDataFrame(rows, "isrc string, week_ending date, streams long")
    plain = {r["series"]: r for r in fit_trend(df, series_cols=["isrc"]).collect()}
    merged = {r["series"]: r for r in fit_trend(df, series_cols=["isrc"], seasonal=True).collect()}
    for s, r in plain.items():
        assert merged[s]["n"] == r["n"] and merged[s]["last_ts"] == r["last_ts"]
        for k in ("tbar", "ybar", "cxx", "cxy", "cyy", "slope", "sigma2"):
            assert merged[s][k] == (r[k] if r[k] is None else pytest.approx(r[k], rel=1e-9))
    assert plain["B"]["slope"] is None and merged["B"]["season"] is None and merged["A"]["season"] is not None


def test_forecast_level(spark):
    rows = [("A", dt.date(2024, 1, 6) + dt.timedelta(days=7 * i), 100 + i % 3) for i in range(20)]
    model = fit_trend(spark.createDataFrame(rows, "isrc string, week_ending date, streams long"))
    half = {z: (lambda r: r["upper_bound"] - r["forecast"])(forecast(model, periods=1, digits=None, **z_).first())
            for z, z_ in (("z", {"level_z": 1.0}), ("level", {"level": 0.9}))}
    assert half["level"] / half["z"] == pytest.approx(1.6448536, rel=1e-6)


def test_cost_params_view_defaults(spark):
    from meterwise.operators.costs import cost_params_view
    params = spark.createDataFrame([("DOLLARS_PER_CREDIT", 2.5)], "param_name string, param_value double")
    got = {r["param_name"]: r["param_value"] for r in cost_params_view(params).collect()}
    assert got == {"DOLLARS_PER_CREDIT": 2.5, "SP_WH_MEDIUM_CREDITS_PER_HOUR": 6.0}


def test_tagged_sets_and_clears_tags(spark):
    from meterwise.session import tagged
    with tagged(spark, "TRAINING", "NATIVE", scheduled=True) as tag:
        assert tag == "WORKLOAD:TRAINING|PATH:NATIVE|SCHEDULED:TRUE"
        assert tag in spark.getTags()
    assert tag not in spark.getTags()


def test_ensure_tables_and_forecast_projection(spark):
    from meterwise.operators.forecast import to_reference_shape
    from meterwise.session import scratch_path
    from meterwise.sources.sinks import ensure_tables
    tables = ensure_tables(spark, scratch_path(spark, "declared"))
    assert set(tables) == {"weekly_input", "scored_output", "forecast_output", "cost_params"}
    fc = forecast(fit_trend(spark.createDataFrame(
        [("A", dt.date(2024, 1, 6) + dt.timedelta(days=7 * i), 10 + i) for i in range(4)],
        "isrc string, week_ending date, streams long")), periods=2)
    shaped = to_reference_shape(fc)
    assert shaped.columns == ["timestamp", "target_value", "target_name", "forecasted_value", "lower_bound",
                              "upper_bound", "horizon", "metric"]
    assert shaped.count() == 2


def test_seasonal_index_recovers_pattern(spark):
    """A flat series with a +100 bump in ISO week 10 of every year forecasts the bump back."""
    start = dt.date(2020, 1, 4)  # a Saturday
    rows = []
    for i in range(3 * 52 + 10):
        d = start + dt.timedelta(days=7 * i)
        rows.append(("A", d, 1000 + (100 if d.isocalendar()[1] == 10 else 0)))
    df = spark.createDataFrame(rows, "isrc string, week_ending date, streams long")
    plain = {r["ts"]: r["forecast"] for r in forecast(fit_trend(df, series_cols=["isrc"]), periods=52).collect()}
    seas = {r["ts"]: r["forecast"] for r in
            forecast(fit_trend(df, series_cols=["isrc"], seasonal=True), periods=52).collect()}
    bump = [t for t in seas if t.isocalendar()[1] == 10]
    other = [t for t in seas if t.isocalendar()[1] not in (10, 53)]
    assert len(bump) == 1
    assert seas[bump[0]] - plain[bump[0]] > 80
    assert max(abs(seas[t] - plain[t]) for t in other) < 20


def test_features_asof_matches_brute_force(spark):
    """Random spine and feature rows (gaps, ties with feature dates, keys without features)."""
    import random

    from meterwise.operators.features import features_asof
    rnd = random.Random(7)
    base = dt.date(2024, 1, 6)
    feats, spine = [], []
    for k in ("a", "b", "c"):
        days = sorted(rnd.sample(range(0, 400), 12))
        feats += [(k, base + dt.timedelta(days=d), float(i)) for i, d in enumerate(days)]
    for k in ("a", "b", "c", "z"):
        spine += [(k, base + dt.timedelta(days=rnd.randrange(-30, 450))) for _ in range(40)]
    spine += [("a", feats[0][1]), ("b", feats[15][1])]          # exactly on a feature date
    fdf = spark.createDataFrame(feats, "isrc string, week_ending date, v double")
    sdf = spark.createDataFrame(spine, "isrc string, ts date")
    got = sorted((r["isrc"], r["ts"], r["week_ending"], r["v"])
                 for r in features_asof(sdf, fdf, key="isrc", spine_ts="ts", feature_ts="week_ending").collect())
    want = []
    for k, t in spine:
        cands = [(d, v) for kk, d, v in feats if kk == k and d <= t]
        d, v = max(cands) if cands else (None, None)
        want.append((k, t, d, v))
    assert got == sorted(want, key=lambda x: (x[0], x[1], x[2] or dt.date.min, x[3] or 0.0))


def test_quality_rules_fail_where_they_should(spark):
    """A dirty weekly frame, checked against the same rules written as SQL and run by DuckDB."""
    import duckdb

    from meterwise.operators.quality import quality_report
    from meterwise.plans.catalog_series import QUALITY_SQL
    from meterwise.schemas import WEEKLY_INPUT
    sat = dt.date(2024, 1, 6)
    rows = [("Global", "T1", "a", "x", sat, sat + dt.timedelta(days=7 * i), 100 + i) for i in range(12)]
    rows += [("Global", "T2", "a", "y", sat, sat, 5), ("Global", "T2", "a", "z", sat, sat, -1),   # dup key, 2 names
             ("US", "T3", "a", "t", sat, sat + dt.timedelta(days=1), 3),                         # bad region, not Sat
             ("Global", None, "a", "t", sat, sat, 1), ("Global", "T4", "a", "t", sat, None, 2)]   # null keys
    df = spark.createDataFrame(rows, WEEKLY_INPUT)
    got = {r["rule"]: (r["failed"], r["total"]) for r in quality_report(df).collect()}
    con = duckdb.connect()
    con.register("weekly_input", df.toPandas())
    want = {r[0]: (r[1], r[2]) for r in con.execute(QUALITY_SQL).fetchall()}
    assert got == want
    assert got["pk_unique"][0] == 1 and got["isrc_single_track"][0] == 1 and got["streams_non_negative"][0] == 1
    assert got["region_allowed"][0] == 1 and got["pk_not_null"][0] == 2 and got["min_history"] == (3, 4)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="WORKLADINGTEFPHSBVC:|_", max_size=40)), min_size=1,
                max_size=8))
def test_classification_matches_case_semantics(spark_session_for_hypothesis, tags):
    """Spark's classification equals a plain reading of the CASE/LIKE chain."""
    def py(tag, prefix, classes, default):
        if tag is None:
            return default
        return next((c for c in classes if f"{prefix}:{c}" in tag), default)

    df = spark_session_for_hypothesis.createDataFrame([(t,) for t in tags], "query_tag string")
    got = [(r["w"], r["p"]) for r in df.select(workload_type().alias("w"), model_path().alias("p")).collect()]
    want = [(py(t, "WORKLOAD", P.WORKLOAD_CLASSES, P.WORKLOAD_DEFAULT), py(t, "PATH", P.PATH_CLASSES, P.PATH_DEFAULT))
            for t in tags]
    assert got == want


def test_labels_name_only_what_the_queries_call():
    import __spark_entry__
    from meterwise.plans.catalog import REGISTRY

    __spark_entry__.queries()
    labels = {name: REGISTRY[name].survey_ids.split() for name in ("refresh_cost_params", "features_asof", "forecast_trend")}
    assert labels == {"refresh_cost_params": ["S9"], "features_asof": ["J6"], "forecast_trend": ["F10", "F11"]}


def test_asof_over_several_views_equals_brute_force(spark):
    import random

    from meterwise.operators.features import features_asof_views
    rng = random.Random(6)
    base = dt.datetime(2024, 1, 1)
    at = lambda: base + dt.timedelta(hours=rng.randint(0, 400))
    views = {}
    for name in ("a", "b"):
        seen = {(rng.choice(["hot", "x", "y"]), at()) for _ in range(120)}
        views[name] = [(k, t, i) for i, (k, t) in enumerate(sorted(seen))]
    spine = [(rng.choice(["hot", "hot", "x", "y", "none", None]), at(), i) for i in range(300)] + [("hot", None, 900), ("hot", views["a"][0][1], 901)]
    frames = {n: (spark.createDataFrame(rows + [(None, base, -1)], "k string, t timestamp, v int"), "t") for n, rows in views.items()}
    got = features_asof_views(spark.createDataFrame(spine, "k string, at timestamp, i int"), frames, key="k", spine_ts="at", bucket_days=2)
    assert got.columns == ["k", "at", "i", "a_t", "a_v", "b_t", "b_v"]
    want = set()
    for k, t, i in spine:
        found = []
        for name in ("a", "b"):
            best = max(((ft, v) for fk, ft, v in views[name] if fk == k and k is not None and t is not None and ft <= t), default=(None, None))
            found += best
        want.add((k, t, i, *found))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(spine) and set(rows) == want
