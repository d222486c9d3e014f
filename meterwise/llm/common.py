"""Helpers shared by the operators of this subpackage: shared storage, hashing of words, components.

Nothing here knows about one operator.  Every eager step writes to the shared
folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import sys
import tempfile
import time
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.session import ensure_checkpoint_dir, scratch_path

#: Odd multipliers of the hashes below (any odd 64-bit numbers serve).
WORD_BASE = 0x9E3779B97F4A7C15
GRAM_BASE = 0xC2B2AE3D27D4EB4F
MASK = (1 << 64) - 1


def ship(spark: SparkSession) -> None:
    """In local mode, make the package importable in Python workers wherever the driver was started.

    On a cluster the package is installed, or given with ``--py-files``.
    """
    sc = spark.sparkContext
    if re.match(r"local(\[|$)", sc.master) and not getattr(sc, "_meterwise_shipped", False):
        root = Path(__file__).resolve().parents[2]
        folder = os.path.realpath(tempfile.mkdtemp(prefix="meterwise-"))
        archive = Path(folder, "meterwise.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted((root / "meterwise").rglob("*.py")):
                out.write(file, file.relative_to(root))
        sc.addPyFile(str(archive))
        sc._meterwise_shipped = True


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Bound what a Python worker holds of whole texts at a time, by rows and by bytes, for jobs whose stages share their workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def release(keep: str = "") -> None:
    """In a Python worker: forget what other operators' tasks remembered there (tokenizers, parsers) and give memory back.

    Workers are reused by one job's stages, so a stage would else start on top of the memories of all before it.
    """
    for name, module in list(sys.modules.items()):
        if name.startswith("meterwise.llm.") and name != keep:
            for value in list(vars(module).values()):
                if hasattr(value, "cache_clear"):
                    value.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not a GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def release_workers(spark: SparkSession) -> None:
    """``release`` in the Python workers of all cores: a job of short waits, two for each core, so that all of them are busy at once."""
    def wait(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        time.sleep(0.1)
        yield from batches

    n = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).mapInPandas(wait, "id long").count()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to shared storage and read back.

    Cuts the lineage, survives lost executors, and gives the planner the
    measured size, so that it broadcasts the table only under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string")) % modulus


# -- words -----------------------------------------------------------------

def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser spreading all bits of 64-bit numbers (wraps around)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]).cumprod(dtype=np.uint64)


class WordHasher:
    """Hashes of the words of one UTF-8 text; a word is a maximal run of ``word_bytes`` after A-Z is lower-cased.

    The hash of a word is its bytes as a polynomial modulo 2**64, mixed; all
    words of a text come from one prefix sum over its bytes.
    """

    def __init__(self, word_bytes: np.ndarray) -> None:
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.is_word = word_bytes[lower]
        self.value = mixed(lower.astype(np.uint64) + np.uint64(1))
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        self.up = _powers(WORD_BASE, n)
        self.down = _powers(pow(WORD_BASE, -1, 1 << 64), n)

    def bounds(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of each word."""
        edge = np.diff(np.concatenate([[0], self.is_word[raw].view(np.int8), [0]]).astype(np.int8))
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def __call__(self, text: bytes) -> np.ndarray:
        raw = np.frombuffer(text, np.uint8)
        start, end = self.bounds(raw)
        if not len(start):
            return np.zeros(0, np.uint64)
        if len(raw) >= len(self.up):
            self._grow(2 * len(raw))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.value[raw] * self.up[: len(raw)], out=total[1:], dtype=np.uint64)
        return mixed((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64))


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(GRAM_BASE) + words[i:i + n]
    return mixed(out)


def class_of_bytes(excluded: Iterator[int]) -> np.ndarray:
    out = np.ones(256, bool)
    out[list(excluded)] = False
    return out


#: Words as runs of anything but space and \t \n \v \f \r.
SPACED_WORDS = class_of_bytes([0x20, *range(0x09, 0x0E)])
#: Words as runs of digits, letters a-z (A-Z are lower-cased first) and everything outside ASCII.
PLAIN_WORDS = class_of_bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


# -- components ------------------------------------------------------------

def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable from each id that has a link.

    Labels start as the smallest neighbour; each round takes the smallest label
    among the neighbours and then the label of that label (pointer jumping), so
    that long chains halve.  Each round is checkpointed; the driver only sees
    the number of changed rows.  Hubs are summed before the shuffle, and a
    hot id on the join side is left to the skew join.
    """
    both = cut(links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
               .select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("e"))
               .select("e.x", "e.y").distinct())
    labels = cut(both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("id"), F.least("x", "y").alias("component")))
    while True:
        near = (both.join(labels.select(F.col("id").alias("y"), "component"), "y")
                .groupBy(F.col("x").alias("id")).agg(F.min("component").alias("near")))
        step = labels.join(near, "id").select("id", F.col("component").alias("before"), F.least("component", "near").alias("c"))
        jump = labels.select(F.col("id").alias("c"), F.col("component").alias("far"))
        after = cut(step.join(jump, "c", "left").select("id", "before", F.least("c", "far").alias("component")))
        changed = after.where("before <> component").limit(1).count()
        labels = after.select("id", "component")
        if not changed:
            return labels
