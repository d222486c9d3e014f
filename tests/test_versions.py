"""Versioned tables: atomic swaps, replays, merges that touch only their buckets."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterwise.schemas import COST_PARAMS
from meterwise.session import scratch_path
from meterwise.sources.versions import CommitConflict, VersionedTable


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_killed_before_the_swap_leaves_the_old_version(spark, monkeypatch):
    t = VersionedTable(spark, scratch_path(spark, "versions"))
    t.replace(spark.sql("SELECT 1L AS a, 'x' AS b"))
    monkeypatch.setattr(t, "_put", lambda manifest: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        t.replace(t.read().withColumn("a", F.col("a") + 1))
    monkeypatch.undo()
    assert values(t.read()) == [(1, "x")]
    assert values(t.replace(t.read().withColumn("a", F.col("a") + 1))) == [(2, "x")]  # a table that reads itself
    assert values(t.read(version=1)) == [(1, "x")]
    folders = [s.getPath().getName() for s in t._fs().listStatus(t._path("_data"))]
    assert len(folders) == 3 and t.expire(keep=1) == 1
    assert len(t._fs().listStatus(t._path("_data"))) == 1 and values(t.read()) == [(2, "x")]


def test_rejected_rows_are_not_swapped_in(spark):
    t = VersionedTable(spark, scratch_path(spark, "versions"))
    t.replace(spark.range(3))

    def check(rows):
        raise ValueError(rows.count())

    with pytest.raises(ValueError, match="5"):
        t.replace(spark.range(5), validate=check)
    assert t.read().count() == 3 and t.manifest()["version"] == 1


def test_two_writers_of_one_version(spark):
    t = VersionedTable(spark, scratch_path(spark, "versions"))
    t.replace(spark.range(1))
    old = t.manifest()
    t.append(spark.range(5))
    with pytest.raises(CommitConflict):
        t._commit(old, spark.range(1).schema, [], None)
    assert t.read().count() == 6


def test_append_is_exactly_once(spark, monkeypatch):
    t = VersionedTable(spark, scratch_path(spark, "versions"))
    t.append(spark.sql("SELECT 1L AS a, 'x' AS b"), batch="7")
    more = spark.sql("SELECT 'y' AS b, 2 AS a")
    monkeypatch.setattr(t, "_put", lambda manifest: (_ for _ in ()).throw(OSError()))
    with pytest.raises(OSError):
        t.append(more, batch="8")  # half written
    monkeypatch.undo()
    for _ in range(3):
        t.append(more, batch="8")
        t.append(more, batch="7")
    assert values(t.read()) == [(1, "x"), (2, "y")] and t.manifest()["batches"] == ["7", "8"]
    assert t.read().schema["a"].dataType.simpleString() == "bigint"


def test_merge_rewrites_only_its_buckets(spark):
    t = VersionedTable(spark, scratch_path(spark, "versions"), keys=["k"], buckets=64)
    t.replace(spark.range(20000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v")))
    before = {f["path"]: f["part"] for f in t.manifest()["files"]}
    assert len(before) == 64
    source = spark.createDataFrame([(5, 50), (19999, 1), (10 ** 9, 2), (None, 3)], "k int, v int")  # narrower types, a null key
    out = t.merge(source, batch="m")
    after = {f["path"]: f["part"] for f in t.manifest()["files"]}
    touched = t.parts_of(source.select(F.col("k").cast("long"), "v"))
    assert set(before.values()) - {before[p] for p in set(before) & set(after)} == touched and len(touched) <= 4
    assert {p for f, p in after.items() if f not in before} == touched
    changed = {r["k"]: r["v"] for r in out.where("v <> 0").collect()}
    assert changed == {5: 50, 19999: 1, 10 ** 9: 2, None: 3} and out.count() == 20002
    t.merge(source.withColumn("v", F.lit(9)), batch="m")  # replayed: nothing
    assert t.read().where("v = 9").isEmpty()
    with pytest.raises(Exception, match="source key repeats"):
        t.merge(source.union(source))


def test_parts_by_expression_and_empty_tables(spark):
    t = VersionedTable(spark, scratch_path(spark, "versions"), part="to_date(at)")
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d, 5), d) for d in (1, 1, 2, 3)] + [(None, 9)], "at timestamp, n int")
    t.replace(rows)
    assert t.parts_of(rows) == {"2024-01-01", "2024-01-02", "2024-01-03", "null"} and t.read(parts=["2024-01-01"]).count() == 2
    t.rewrite({"2024-01-01"}, lambda r: r.withColumn("n", F.col("n") * 10), schema=rows.schema)
    assert sorted(r["n"] for r in t.read().collect()) == [2, 3, 9, 10, 10]
    with pytest.raises(ValueError):
        t.rewrite({"2024-01-02"}, lambda r: rows, schema=rows.schema)
    e = VersionedTable(spark, scratch_path(spark, "versions"), keys=["param_name"], buckets=4)
    assert e.create(COST_PARAMS).count() == 0 and e.create(COST_PARAMS).schema == COST_PARAMS and e.manifest()["version"] == 1
    with pytest.raises(ValueError):
        VersionedTable(spark, "x", keys=["a"], buckets=3)
