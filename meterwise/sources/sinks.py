"""Writing tables: create, replace, append, staged replace and keyed upsert.

Tables are parquet folders (or catalog tables when a name without a slash is
given).  Nothing is collected to the driver; every write is a Spark job.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise.session import scratch_path


def _stamp(stamp: dt.datetime | None):
    """A timestamp literal read in the session time zone (now when None)."""
    if stamp is None:
        return F.current_timestamp()
    return F.lit(stamp.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def _is_path(name: str) -> bool:
    return "/" in name or ":" in name


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """Create an empty table with ``schema`` unless it already exists."""
    if _is_path(name):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(name)
        return spark.read.parquet(name)
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    return spark.table(name)


def ensure_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Create every declared table under ``root`` unless it exists."""
    from meterwise import schemas as S
    declared = {"weekly_input": S.WEEKLY_INPUT, "scored_output": S.SCORED_OUTPUT,
                "forecast_output": S.FORECAST_OUTPUT, "cost_params": S.COST_PARAMS}
    return {name: ensure_table(spark, f"{root.rstrip('/')}/{name}", schema) for name, schema in declared.items()}


def values_df(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """An inline literal relation with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE ... AS SELECT."""
    if _is_path(name):
        df.write.mode("overwrite").parquet(name)
        return df.sparkSession.read.parquet(name)
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str) -> DataFrame:
    """INSERT INTO ... SELECT (columns matched by name)."""
    spark = df.sparkSession
    if _is_path(name):
        target = ensure_table(spark, name, df.schema)
        df.select(*[F.col(f.name).cast(f.dataType) for f in target.schema]).write.mode("append").parquet(name)
        return spark.read.parquet(name)
    target_cols = spark.table(name).columns
    df.select(*target_cols).write.insertInto(name)
    return spark.table(name)


def staged_replace(df: DataFrame, name: str, *, validate=None) -> DataFrame:
    """Write beside the target, then swap by renaming: one write, and nothing staged is left behind.

    The target may be an input of ``df``.  ``validate`` gets the staged rows and
    may raise before the target is touched.  Between the two renames the target
    is missing for a moment; tables that are read while they are replaced belong
    in ``sources.versions``, whose swap is a single rename.  A catalog table is
    staged in scratch and overwritten.
    """
    spark = df.sparkSession
    if not _is_path(name):
        stage = scratch_path(spark, "staging")
        df.write.mode("overwrite").parquet(stage)
        staged = spark.read.parquet(stage)
        if validate is not None:
            validate(staged)
        return replace_table(staged, name)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    mark = uuid.uuid4().hex[:12]
    target, stage, old = (path(f"{name.rstrip('/')}{suffix}") for suffix in ("", f".staged-{mark}", f".replaced-{mark}"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.parquet(stage.toString())
    try:
        if validate is not None:
            validate(spark.read.schema(df.schema).parquet(stage.toString()))
    except BaseException:
        fs.delete(stage, True)
        raise
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot move {name} aside")
    if not fs.rename(stage, target):
        fs.rename(old, target)
        raise OSError(f"cannot move the new rows to {name}")
    fs.delete(old, True)
    return spark.read.parquet(name)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
           stamp_col: str | None = None, stamp: dt.datetime | None = None) -> DataFrame:
    """Keyed MERGE: update matched rows (and their stamp), insert the rest.

    Expressed as a full outer join on the keys; the result is a DataFrame to be
    written with :func:`staged_replace`.  A key that repeats in the source fails
    the merge; null keys match null keys.
    """
    keys = list(keys)
    value_cols = [c for c in target.columns if c not in keys and c != stamp_col]
    t = target.alias("t")
    once = F.count(F.lit(1)).over(Window.partitionBy(*keys)) == 1
    s = (source.withColumn("_once", F.when(once, F.lit(True)).otherwise(F.raise_error(F.lit("merge: a source key repeats")).cast("boolean")))
         .alias("s"))
    cond = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    joined = t.join(s, cond, "full_outer")
    matched = F.coalesce(F.col("s._once"), F.lit(False))
    out = [F.coalesce(F.col(f"s.{k}"), F.col(f"t.{k}")).alias(k) for k in keys]
    for c in value_cols:
        if c in source.columns:
            out.append(F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    if stamp_col is not None:
        new_stamp = _stamp(stamp)
        out.append(F.when(matched, new_stamp).otherwise(F.col(f"t.{stamp_col}")).alias(stamp_col))
    return joined.select(*out).select(*target.columns)


def set_param(params: DataFrame, name: str, value: float | Column, stamp: dt.datetime | None = None) -> DataFrame:
    """UPDATE params SET value = ... WHERE param_name = name; ``value`` is a number or a scalar column."""
    hit = F.col("param_name") == name
    new = value if isinstance(value, Column) else F.lit(float(value))
    out = params.withColumn("param_value", F.when(hit, new).otherwise(F.col("param_value")))
    if "updated_at" in params.columns:
        new_stamp = _stamp(stamp)
        out = out.withColumn("updated_at", F.when(hit, new_stamp).otherwise(F.col("updated_at")))
    return out
