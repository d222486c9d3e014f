"""Versioned tables: immutable Parquet files under a manifest that one rename swaps.

    <root>/_data/<commit>/part=<p>/*.parquet     written once, never changed
    <root>/_manifests/<version>.json             the files of a version, its schema and the batches it holds

A commit writes new files, then its manifest under a temporary name, and renames
that to the next version, which fails if another writer took the number.  Until
the rename readers see the old version; a job that dies before it leaves only
unreferenced files, which ``expire`` removes.  Batch ids are part of the
manifest, so a replayed batch changes nothing.

Files are kept by part: a hashed range of the key columns, or any expression
(a day).  A merge reads and rewrites only the parts its source meets.

The rename must be atomic and refuse an existing target, as on HDFS and local
file systems; on an object store use a committer or catalog that gives the same.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "_part"
#: Batch ids a manifest remembers; only the newest can be replayed.
REMEMBERED = 1000
#: Rows a task writes to one file of a part; larger parts are written by several tasks.
ROWS_PER_FILE = 2_000_000


class CommitConflict(RuntimeError):
    """Another writer committed the version first; read again and retry."""


class VersionedTable:
    """A table at ``root``; ``keys`` (with ``buckets``, a power of two) or ``part`` say how a new table is laid out."""

    def __init__(self, spark: SparkSession, root: str, *, keys: Sequence[str] = (), buckets: int = 1, part: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        if buckets < 1 or buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self._layout = {"keys": list(keys), "buckets": buckets, "part": part}

    # -- file system -------------------------------------------------------

    def _path(self, name: str = ""):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        fs, folder = self._fs(), self._path("_manifests")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _put(self, manifest: dict) -> None:
        fs, jvm = self._fs(), self.spark.sparkContext._jvm
        fs.mkdirs(self._path("_manifests"))
        temporary, final = self._path(f"_manifests/.{uuid.uuid4().hex}"), self._path(f"_manifests/{manifest['version']:012d}.json")
        out = fs.create(temporary, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(temporary), fs.makeQualified(final), none)
        except Exception as e:  # the target exists: another writer was first
            fs.delete(temporary, False)
            if fs.exists(final):
                raise CommitConflict(f"{self.root}: version {manifest['version']} exists") from e
            raise

    # -- reading -----------------------------------------------------------

    def exists(self) -> bool:
        return bool(self._versions())

    def manifest(self, version: int | None = None) -> dict:
        versions = self._versions()
        if not versions or (version is not None and version not in versions):
            raise FileNotFoundError(f"{self.root} has no version {'' if version is None else version}")
        stream = self._fs().open(self._path(f"_manifests/{versions[-1] if version is None else version:012d}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _frame(self, manifest: dict, parts: Iterable[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        wanted = None if parts is None else set(parts)
        files = [f"{self.root}/{f['path']}" for f in manifest["files"] if wanted is None or f["part"] in wanted]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """A version of the table (the newest), or some of its parts."""
        return self._frame(self.manifest(version), parts)

    def holds(self, batch: str) -> bool:
        return self.exists() and batch in self.manifest()["batches"]

    # -- writing -----------------------------------------------------------

    @staticmethod
    def _part_of(layout: dict) -> Column:
        if layout["part"] is not None:
            return F.coalesce(F.expr(layout["part"]).cast("string"), F.lit("null"))
        if not layout["keys"] or layout["buckets"] == 1:
            return F.lit("0")
        bits = layout["buckets"].bit_length() - 1  # the leading bits of the hash: each bucket is one range of hashes
        return F.shiftrightunsigned(F.xxhash64(*layout["keys"]), 64 - bits).cast("string")

    def parts_of(self, df: DataFrame) -> set[str]:
        """Parts that ``df`` meets: at most one string per part reaches the driver."""
        layout = self.manifest()["layout"] if self.exists() else self._layout
        return {r[0] for r in df.select(self._part_of(layout).alias("p")).distinct().collect()}

    def _write(self, df: DataFrame, layout: dict) -> list[dict]:
        """``df`` as new files, one or a few per part; returns their manifest entries."""
        commit = f"_data/{uuid.uuid4().hex}"
        dealt = df.withColumn(PART, self._part_of(layout))
        if layout["part"] is not None or layout["buckets"] > 1:  # by part, so that a part is few files whatever wrote it
            dealt = dealt.repartition(PART)
        dealt.write.partitionBy(PART).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{self.root}/{commit}")
        unquote = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        files, found = [], self._fs().listFiles(self._path(commit), True)
        while found.hasNext():
            path = found.next().getPath()
            if path.getName().endswith(".parquet"):
                files.append({"path": f"{commit}/{path.getParent().getName()}/{path.getName()}", "part": unquote(path.getParent().getName()[len(PART) + 1:])})
        return sorted(files, key=lambda f: f["path"])

    def _commit(self, old: dict | None, schema: T.StructType, files: list[dict], batch: str | None) -> DataFrame:
        manifest = {"version": old["version"] + 1 if old else 1, "schema": schema.jsonValue(), "layout": old["layout"] if old else self._layout,
                    "files": files, "batches": [*(old["batches"] if old else []), *([batch] if batch is not None else [])][-REMEMBERED:]}
        self._put(manifest)
        return self._frame(manifest)

    def _old(self) -> dict | None:
        return self.manifest() if self.exists() else None

    def create(self, schema: T.StructType) -> DataFrame:
        """The table, empty where it is new."""
        old = self._old()
        return self._frame(old) if old else self._commit(None, schema, [], None)

    def replace(self, df: DataFrame, *, validate: Callable[[DataFrame], None] | None = None, batch: str | None = None) -> DataFrame:
        """All rows by those of ``df``, which may read the table itself; ``validate`` sees the written rows and may raise before the swap."""
        old = self._old()
        if old and batch is not None and batch in old["batches"]:
            return self._frame(old)
        layout = old["layout"] if old else self._layout
        files = self._write(df, layout)
        if validate is not None:
            validate(self._frame({"schema": df.schema.jsonValue(), "files": files}))
        return self._commit(old, df.schema, files, batch)

    def append(self, df: DataFrame, *, batch: str | None = None) -> DataFrame:
        """Rows added, columns matched by name and cast; a ``batch`` the table holds already adds nothing."""
        old = self._old()
        if old is None:
            return self._commit(None, df.schema, self._write(df, self._layout), batch)
        if batch is not None and batch in old["batches"]:
            return self._frame(old)
        schema = T.StructType.fromJson(old["schema"])
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        return self._commit(old, schema, old["files"] + self._write(rows, old["layout"]), batch)

    def rewrite(self, parts: set[str], change: Callable[[DataFrame], DataFrame], *, schema: T.StructType, batch: str | None = None) -> DataFrame:
        """``change`` applied to the rows of ``parts``, whose files are replaced; all others stay as they are."""
        old = self._old()
        if old and batch is not None and batch in old["batches"]:
            return self._frame(old)
        now = self._frame(old, parts) if old else self.spark.createDataFrame([], schema)
        files = self._write(change(now), old["layout"] if old else self._layout)
        if not {f["part"] for f in files} <= parts:
            raise ValueError("rows left the parts being rewritten")
        kept = [f for f in old["files"] if f["part"] not in parts] if old else []
        return self._commit(old, schema, kept + files, batch)

    def merge(self, source: DataFrame, *, stamp_col: str | None = None, stamp: dt.datetime | None = None, batch: str | None = None) -> DataFrame:
        """Keyed upsert of ``source`` (see ``sinks.upsert``) into the buckets its keys fall in."""
        from meterwise.sources.sinks import upsert

        old = self.manifest()
        if batch is not None and batch in old["batches"]:
            return self._frame(old)
        keys = old["layout"]["keys"]
        schema = T.StructType.fromJson(old["schema"])
        typed = source.select(*[F.col(c).cast(schema[c].dataType) for c in source.columns])  # equal keys must hash alike
        return self.rewrite(self.parts_of(typed), lambda rows: upsert(rows, typed, keys, stamp_col=stamp_col, stamp=stamp), schema=schema, batch=batch)

    def expire(self, keep: int = 2) -> int:
        """Drop all but the newest ``keep`` versions and the files only they held; returns the number of files deleted.

        Commit folders without a file in a kept version go whole: what a failed
        writer left, too, so run it when no writer is under way.
        """
        versions, fs = self._versions(), self._fs()
        held = {f["path"] for v in versions[-keep:] for f in self.manifest(v)["files"]}
        gone = {f["path"] for v in versions[:-keep] for f in self.manifest(v)["files"]} - held
        for path in gone:
            fs.delete(self._path(path), False)
        for v in versions[:-keep]:
            fs.delete(self._path(f"_manifests/{v:012d}.json"), False)
        live = {path.split("/")[1] for path in held}
        data = self._path("_data")
        for s in fs.listStatus(data) if fs.exists(data) else []:
            if s.getPath().getName() not in live:
                fs.delete(s.getPath(), True)
        return len(gone)
