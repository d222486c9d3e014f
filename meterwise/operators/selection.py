"""Exact order statistics per group by histogram refinement.

A sort or a ``percentile`` buffer holds all distinct values of a group in one
task.  Here each value first becomes one weighted row (a hash aggregate with
partial sums), and a rank is then narrowed down: count the values of an
interval in ``buckets`` equal parts, keep the part that holds the rank, shrink
it to its own least and greatest value, and go on until both are equal.  A task
only ever holds partial counts; a group gives at most ``buckets`` rows per pass.
Two or three passes are usual; every pass leaves out at least one end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.session import materialised


def select_ranks(df: DataFrame, group_cols: Sequence[str], value: str, ranks: dict[str, Column], buckets: int = 4096) -> DataFrame:
    """One row per group: group columns, ``n`` (values that are neither null nor NaN) and the value at each rank.

    ``ranks`` maps an output name to a 0-based rank, an expression over ``n``;
    a rank outside ``0 .. n - 1`` gives null.  Infinite values are ordered as
    the ends they are, but not bucketed, so they are taken off first.
    """
    groups = [F.col(c) for c in group_cols]
    x = F.col(value)
    kind = df.schema[value].dataType.simpleString()
    present = x.isNotNull() & ~F.isnan(x.cast("double"))
    values = materialised(df.where(present).groupBy(*groups, x.alias("_x")).agg(F.count(F.lit(1)).alias("_w")), "values")
    inf = F.lit(float("inf"))
    ends = values.groupBy(*groups).agg(
        F.sum("_w").alias("n"), F.sum(F.when(F.col("_x").cast("double") == -inf, F.col("_w")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.abs(F.col("_x").cast("double")) < inf, F.col("_w")).otherwise(0)).alias("_finite"),
        *(f(F.when(F.abs(F.col("_x").cast("double")) < inf, F.col("_x"))).alias(n) for f, n in ((F.min, "_lo"), (F.max, "_hi"))))
    wanted = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), r.cast("long").alias("rank")) for n, r in ranks.items())))
    state = ends.select(*groups, "n", "_below", "_finite", "_lo", "_hi", wanted.alias("r")).select(*groups, "n", "_below", "_finite", "_lo", "_hi", "r.*")
    low, high = F.col("rank") < F.col("_below"), F.col("rank") >= F.col("_below") + F.col("_finite")
    state = state.withColumns({"_lo": F.when(low, (-inf).cast(kind)).when(high, inf.cast(kind)).otherwise(F.col("_lo")) if kind in ("double", "float") else F.col("_lo"),
                               "_hi": F.when(low, (-inf).cast(kind)).when(high, inf.cast(kind)).otherwise(F.col("_hi")) if kind in ("double", "float") else F.col("_hi"),
                               "_before": F.col("_below")}).where((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
    columns = [*group_cols, "name", "rank", "_before", "_lo", "_hi"]
    state = materialised(state.select(*columns), "ranks")
    while True:
        active = state.where("_lo < _hi")
        if active.isEmpty():
            break
        a, v = active.alias("a"), values.alias("v")
        same = F.lit(True)
        for c in group_cols:
            same &= F.col(f"a.{c}").eqNullSafe(F.col(f"v.{c}"))
        part = F.floor((F.col("_x") - F.col("_lo")).cast("double") / (F.col("_hi") - F.col("_lo")).cast("double") * buckets)
        inside = (a.join(v, same & (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
                  .groupBy(*[F.col(f"a.{c}").alias(c) for c in group_cols], "name", "rank", "_before", F.least(part, F.lit(buckets - 1)).alias("_part"))
                  .agg(F.sum("_w").alias("_w"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
        upto = F.sum("_w").over(Window.partitionBy(*group_cols, "name").orderBy("_part"))  # one group's parts, ``buckets`` at most
        kept = (inside.withColumn("_upto", F.col("_before") + upto).where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_w")))
                .withColumn("_before", F.col("_upto") - F.col("_w")))
        state = materialised(kept.select(*columns).unionByName(state.where("not (_lo < _hi)")), "ranks")
    found = state.groupBy(*groups).agg(*(F.max(F.when(F.col("name") == n, F.col("_lo"))).alias(n) for n in ranks)) if group_cols else \
        state.agg(*(F.max(F.when(F.col("name") == n, F.col("_lo"))).alias(n) for n in ranks))
    if not group_cols:
        return ends.select("n").crossJoin(F.broadcast(found))  # one row each
    f, e = found.alias("f"), ends.select(*groups, "n").alias("e")
    same = F.lit(True)
    for c in group_cols:
        same &= F.col(f"e.{c}").eqNullSafe(F.col(f"f.{c}"))
    return e.join(f, same, "left").select("e.*", *(F.col(f"f.{n}") for n in ranks))


def median(df: DataFrame, group_cols: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group: the middle value, or the mean of the two middle ones."""
    n = F.col("n")
    found = select_ranks(df, group_cols, value, {"_low": F.floor((n - 1) / 2), "_high": F.ceil((n - 1) / 2)})
    return found.select(*group_cols, "n", (F.col("_low") * 0.5 + F.col("_high") * 0.5).alias(name))
