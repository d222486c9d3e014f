"""Exact order statistics by histogram refinement, against sorted lists."""

from __future__ import annotations

import math
import random
from statistics import median as middle

import pytest
from pyspark.sql import functions as F

from meterwise.operators import dashboard as D
from meterwise.operators.selection import median, select_ranks
from meterwise.sources.logs import usage_logs
from tests.conftest import SF_SMALL
from tests.test_plans import plan_text


@pytest.mark.parametrize("buckets", [2, 7, 4096])
def test_ranks_with_ties_and_a_dominant_group(spark, buckets):
    rng = random.Random(1)
    data = {"hot": [rng.choice([rng.gauss(0, 1), 3.25, rng.expovariate(1) * 10.0 ** rng.randint(-9, 9)]) for _ in range(3000)],
            "ties": [7.0] * 500 + [8.0], "one": [-4.5], None: [float(i) for i in range(10)], "even": [1.0, 2.0, 4.0, 8.0]}
    rows = [(g, x) for g, xs in data.items() for x in xs] + [("hot", None), ("nothing", None), ("one", float("nan"))]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    n = F.col("n")
    found = {r["g"]: r for r in select_ranks(df, ["g"], "x", {"first": F.lit(0), "third": F.floor(n / 3), "last": n - 1, "beyond": n}, buckets).collect()}
    assert set(found) == set(data)
    for g, xs in data.items():
        xs = sorted(xs)
        assert (found[g]["n"], found[g]["first"], found[g]["third"], found[g]["last"], found[g]["beyond"]) == (len(xs), xs[0], xs[len(xs) // 3], xs[-1], None)
    got = {r["g"]: r["m"] for r in median(df, ["g"], "x", "m").collect()}
    assert all(got[g] == 0.5 * sorted(xs)[(len(xs) - 1) // 2] + 0.5 * sorted(xs)[len(xs) // 2] and math.isclose(got[g], middle(xs)) for g, xs in data.items())


def test_ranks_of_integers_infinities_and_nothing(spark):
    whole = spark.createDataFrame([(v,) for v in [5, -(10 ** 17), 10 ** 17, 10 ** 17 + 1, 6]], "x long")
    assert tuple(select_ranks(whole, [], "x", {"a": F.lit(3), "b": F.lit(4)}).first()) == (5, 10 ** 17, 10 ** 17 + 1)
    ends = spark.createDataFrame([(float(v),) for v in ["-inf", "1", "2", "inf", "inf"]], "x double")
    got = select_ranks(ends, [], "x", {f"r{i}": F.lit(i) for i in range(5)}).first()
    assert tuple(got) == (5, -math.inf, 1.0, 2.0, math.inf, math.inf)
    assert select_ranks(ends.withColumn("g", F.lit(1)).where("false"), ["g"], "x", {"a": F.lit(0)}).count() == 0


def test_workload_perf_has_no_buffer_of_values(spark):
    df = D.workload_perf(usage_logs(spark, SF_SMALL, 7).qh)
    assert not any(word in plan_text(df, "extended").lower() for word in ("percentile", "median("))
