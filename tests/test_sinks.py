"""Table writes: ensure, replace, append, staged replace over its own input."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterwise.schemas import WEEKLY_INPUT
from meterwise.session import scratch_path
from meterwise.sources.sinks import append_table, ensure_table, replace_table, staged_replace, upsert


def test_table_lifecycle(spark):
    path = scratch_path(spark, "sink_test")
    empty = ensure_table(spark, path, WEEKLY_INPUT)
    assert empty.count() == 0 and empty.schema == WEEKLY_INPUT
    df = spark.createDataFrame([("Global", "B#1", "a", "t", None, None, 5)], WEEKLY_INPUT)
    replace_table(df, path)
    append_table(df, path)
    assert spark.read.parquet(path).count() == 2
    # The staged copy lets a job overwrite the table it reads.
    out = staged_replace(spark.read.parquet(path).withColumn("streams", F.col("streams") * 2), path)
    assert [r["streams"] for r in out.collect()] == [10, 10]


def test_merge_fails_on_a_repeated_source_key_and_matches_nulls(spark):
    target = spark.createDataFrame([(1, 10), (None, 20)], "k long, v long")
    source = spark.createDataFrame([(None, 21), (2, 30)], "k long, v long")
    assert sorted(((r["k"], r["v"]) for r in upsert(target, source, ["k"]).collect()), key=str) == [(1, 10), (2, 30), (None, 21)]
    with pytest.raises(Exception, match="source key repeats"):
        upsert(target, source.union(source), ["k"]).collect()


def test_cluster_without_shared_folder_is_an_error(monkeypatch):
    from types import SimpleNamespace

    from meterwise import session

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="local-cluster[2,1,1024]")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf={}))


def test_append_to_a_path_matches_columns_by_name_and_type(spark, tmp_path):
    path = str(tmp_path / "appended")
    append_table(spark.sql("SELECT 1L AS a, 'x' AS b"), path)
    out = append_table(spark.sql("SELECT 'y' AS b, 2 AS a"), path)
    assert sorted(map(tuple, out.select("a", "b").collect())) == [(1, "x"), (2, "y")]
    assert out.schema["a"].dataType.simpleString() == "bigint"
    with pytest.raises(AnalysisException):
        append_table(spark.sql("SELECT 3L AS a"), path)
