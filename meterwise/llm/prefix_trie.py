"""Conversation prefix trie with count-min screening.

Each conversation has one digest per prefix.  A count-min sketch of all digests
never counts too little, so an estimate of one proves that a prefix, and with it
every longer prefix of that conversation, belongs to it alone.  These tails are
finished where they are.  Only the leading prefixes that may be shared are
shuffled, by digest, and counted exactly.

The sums over subtrees need no walk through the trie: the smallest member of a
node is also the smallest of every deeper node on its own path, so each
conversation owns the lower end of its path, every node has one owner, and the
sum over a node's subtree is what its members own less what its smallest member
owns above it.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.llm.common import mixed, written

#: Rows of the sketch; its width follows the number of turns.
DEPTH = 4
#: Sketch cells that travel as one row.
CELLS = 1 << 14
#: Ids hashed as one piece of text.
IDS = 1 << 14

_ROOT = hashlib.sha256(b"root").digest()[:16]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- rebuilding ------------------------------------------------------------

def rebuilt(turns: DataFrame, family: int = 5, most: int = 9, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text): conversations with a shared beginning; one that has no turn left has a row of nulls.

    Conversation c begins with the first h turns of conversation c - c % ``family``
    and goes on with its own behind its first h, h = crc32(c as text) % ``most``.
    Turns are ordered by turn (null first), then role and text; rows without a
    conv_id are left out.  A conversation sends its first ``most`` - 1 turns to
    its family's ids, existing or not; ids without rows of their own are dropped after that.
    """
    kind = turns.schema[conv_id].dataType
    order = Window.partitionBy("c").orderBy(F.col("t").asc_nulls_first(), "r", "x")
    rows = (turns.where(F.col(conv_id).isNotNull())
            .select(F.col(conv_id).cast("long").alias("c"), F.col(turn).alias("t"), F.coalesce(role, F.lit("")).alias("r"), F.coalesce(text, F.lit("")).alias("x"))
            .withColumn("k", F.row_number().over(order)))

    def h(c: Column) -> Column:
        return F.crc32(c.cast("string").cast("binary")) % most

    relatives = F.filter(F.sequence(F.col("c") - (family - 1), F.col("c") + (family - 1)), lambda j: (j - j % family == F.col("c")) & (F.col("k") <= h(j)))
    relatives = F.when((F.col("k") < most) & (F.col("c") % family == 0), relatives).otherwise(F.array().cast("array<long>"))
    own = F.struct(F.col("c").alias("to"), (F.col("k") > h(F.col("c"))).alias("used"), F.lit(True).alias("own"))
    sent = F.concat(F.array(own), F.transform(relatives, lambda j: F.struct(j.alias("to"), F.lit(True).alias("used"), F.lit(False).alias("own"))))
    sent = rows.select("k", "r", "x", F.explode(sent).alias("s")).where("s.used or k = 1").select(
        F.col("s.to").alias("c"), "s.own", *(F.when(F.col("s.used"), F.col(x)).alias(x) for x in ("k", "r", "x")))
    there = sent.withColumn("own", F.max("own").over(Window.partitionBy("c"))).where("own")
    return there.select(F.col("c").cast(kind).alias(conv_id), F.col("k").alias(turn), F.col("r").alias(role), F.col("x").alias(text))


# -- chains of digests -----------------------------------------------------

def _chains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(conv, chain, sizes) from sorted turns: the digest of each prefix but the empty one, 16 bytes each and joined, and the bytes of each text."""
    at, before, chain, sizes = None, _ROOT, [], []
    for batch in batches:
        out = []
        for conv, r, x, there in zip(batch["c"], batch["r"], batch["x"], batch["there"]):
            if conv != at:
                if at is not None:
                    out.append((at, b"".join(chain), sizes))
                at, before, chain, sizes = conv, _ROOT, [], []
            if there:
                raw, name = x.encode("utf-8", "surrogatepass"), r.encode("utf-8", "surrogatepass")
                before = hashlib.sha256(before + struct.pack("<q", len(name)) + name + raw).digest()[:16]
                chain.append(before)
                sizes.append(len(raw))
        yield pd.DataFrame(out, columns=["conv", "chain", "sizes"])
    if at is not None:
        yield pd.DataFrame([(at, b"".join(chain), sizes)], columns=["conv", "chain", "sizes"])


def chains(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("c"), F.col(turn).alias("t"), F.coalesce(role, F.lit("")).alias("r"), F.coalesce(text, F.lit("")).alias("x"),
        (F.col(role).isNotNull() | F.col(text).isNotNull() | F.col(turn).isNotNull()).alias("there"))
    return (rows.repartition("c").sortWithinPartitions("c", F.col("t").asc_nulls_first(), "r", "x").select("c", "r", "x", "there")
            .mapInPandas(_chains, "conv long, chain binary, sizes array<long>"))


# -- count-min sketch ------------------------------------------------------

def _cells(chain: bytes, width: int) -> np.ndarray:
    """Cells of each digest of a chain, one row of the sketch after the other; digests are even already, so two halves give all rows."""
    halves = np.frombuffer(chain, np.uint64).reshape(-1, 2)
    rows = np.arange(DEPTH, dtype=np.uint64)[:, None]
    return (mixed(halves[:, 0] + rows * halves[:, 1]) % np.uint64(width)).astype(np.int64) + rows.astype(np.int64) * width


def sketch(rows: DataFrame, width: int) -> DataFrame:
    """(block, cells): the sketch of all digests in rows of ``CELLS`` counters, which saturate at two: more is not asked."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(-(-DEPTH * width // CELLS) * CELLS, np.uint8)
        for batch in batches:
            at = np.concatenate([_cells(c, width).ravel() for c in batch["chain"]] or [np.zeros(0, np.int64)])
            cell, n = np.unique(at, return_counts=True)
            seen[cell] = np.minimum(seen[cell] + np.minimum(n, 2), 2)
        for block in np.flatnonzero(seen.reshape(-1, CELLS).any(axis=1)):
            cells = seen[block * CELLS:(block + 1) * CELLS]
            yield pd.DataFrame({"block": [int(block)], "cells": [np.packbits(np.stack([cells >= 1, cells >= 2])).tobytes()]})

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        one, two = np.zeros(CELLS, bool), np.zeros(CELLS, bool)
        for raw in frame["cells"]:
            a, b = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(2, CELLS).astype(bool)
            two |= b | (one & a)
            one |= a
        return pd.DataFrame({"block": frame["block"].iloc[:1], "cells": [np.packbits(two).tobytes()]})

    return rows.select("chain").mapInPandas(count, "block long, cells binary").groupBy("block").applyInPandas(merge, "block long, cells binary")


def screen(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with ``shared``: how many leading prefixes may belong to a second conversation.

    The merged sketch, one bit a cell (met twice or more), is read by each task from
    a broadcast of its ``DEPTH`` x ``width`` bits; ``trie`` bounds the width.
    """
    table = np.zeros(-(-DEPTH * width // CELLS) * CELLS // 8, np.uint8)
    for r in sketch(rows, width).toLocalIterator():
        table[r["block"] * CELLS // 8:(r["block"] + 1) * CELLS // 8] = np.frombuffer(r["cells"], np.uint8)
    held = rows.sparkSession.sparkContext.broadcast(table.tobytes())

    @F.pandas_udf("int")
    def shared(chain: pd.Series) -> pd.Series:
        bits = np.frombuffer(held.value, np.uint8)
        out = []
        for c in chain:
            at = _cells(c, width)
            often = ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
            out.append(len(often) if often.all() else int(np.argmin(often)))
        return pd.Series(out, dtype="int32")

    return rows.withColumn("shared", shared("chain"))


# -- the trie --------------------------------------------------------------

_PREFIX = "digest binary, parent binary, depth long, size long, conv long, tails long, ended boolean"


def _prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per prefix that may be shared, the root's among them; tails: whether the conversation goes on alone behind it."""
    names = [c.split()[0] for c in _PREFIX.split(", ")]
    for batch in batches:
        out = []
        for conv, chain, sizes, shared in zip(batch["conv"], batch["chain"], batch["sizes"], batch["shared"]):
            own = [_ROOT, *(chain[i:i + 16] for i in range(0, 16 * shared, 16))]
            out += [(d, own[k - 1] if k else None, k, int(sizes[k - 1]) if k else 0, conv, int(k == shared < len(sizes)), k == len(sizes))
                    for k, d in enumerate(own)]
        yield pd.DataFrame(out, columns=names)


def _tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The finished nodes of each conversation's tail; the first hangs below a node that may be shared, the others below the conversation's own."""
    for batch in batches:
        out = []
        for conv, sizes, shared, above in zip(batch["conv"], batch["sizes"], batch["shared"], batch["parent_conv_id"]):
            n = len(sizes)
            own = hashlib.sha256(str(conv).encode()).hexdigest()
            out += [(conv, k, above if k == shared + 1 else conv, int(k < n), own if k == n else _NO_ENDS) for k in range(shared + 1, n + 1)]
        yield pd.DataFrame(out, columns=["conv_id", "depth", "parent_conv_id", "n_children", "ends_sha256"])


def _with_parent(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` (parent, ...) with the parent's smallest member.

    No parent is met more often than it has children, so those with a thousandth
    of all children or more, a thousand at most, are broadcast; the others are
    joined by a shuffle in which none of them is hot.
    """
    many = nodes.agg(F.sum("n_children")).first()[0] or 0
    known = nodes.select(F.col("digest").alias("parent"), F.col("conv").alias("parent_conv_id"), (F.col("n_children") * 1000 >= max(many, 1)).alias("hot"))
    hot = known.where("hot").select("parent", F.col("parent_conv_id").alias("hot_conv"))
    seen = rows.join(F.broadcast(hot), "parent", "left")
    cold = seen.where("hot_conv is null").drop("hot_conv").join(known.where("not hot").drop("hot"), "parent", "left")
    return seen.where("hot_conv is not null").withColumnRenamed("hot_conv", "parent_conv_id").unionByName(cold)


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (digest, conv) rows as pieces of text: (digest, first, ids)."""
    for batch in batches:
        out, at = [], None
        for digest, conv in zip(batch["digest"], batch["conv"]):
            if at is None or digest != at or len(out[-1][2]) == IDS:
                at = digest
                out.append((digest, conv, []))
            out[-1][2].append(str(conv))
        yield pd.DataFrame([(d, first, ",".join(ids)) for d, first, ids in out], columns=["digest", "first", "ids"])


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each digest's pieces in order, as a stream: only the state of the hash is held."""
    at, state = None, None
    for batch in batches:
        out = []
        for digest, ids in zip(batch["digest"], batch["ids"]):
            if at is not None and bytes(digest) == at:
                state.update(b"," + ids.encode())
                continue
            if at is not None:
                out.append((at, state.hexdigest()))
            at, state = bytes(digest), hashlib.sha256(ids.encode())
        yield pd.DataFrame(out, columns=["digest", "ends_sha256"])
    if at is not None:
        yield pd.DataFrame([(at, state.hexdigest())], columns=["digest", "ends_sha256"])


def ends_of(rows: DataFrame) -> DataFrame:
    """(digest, ends_sha256) over the conversations that end at a node, ascending.

    Rows are dealt by ranges of (digest, conv), so that a node where very many
    end spreads over tasks; what is hashed in order is their joined text.
    """
    pieces = (rows.repartitionByRange("digest", "conv").sortWithinPartitions("digest", "conv")
              .mapInPandas(_joined, "digest binary, first long, ids string"))
    return pieces.repartition("digest").sortWithinPartitions("digest", "first").mapInPandas(_hashed, "digest binary, ends_sha256 string")


def trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", sketch_bytes: int = 16 << 20) -> DataFrame:
    """One row per distinct sequence of first turns (a node), the empty one among them.

    conv_id (smallest member), depth, parent_conv_id (the parent's conv_id),
    n_convs (members: conversations that start so), n_children, n_leaves
    (childless nodes below or at it), saved_tokens (over the nodes below and at
    it: members but one, times the UTF-8 bytes of its last text) and ends_sha256
    (of the ids of the members that end there).

    Turns are ordered by turn (null first), then role and text; a null role or
    text is empty; repeated rows are turns of their own; rows without a conv_id
    are left out.  A row whose turn, role and text are all null says that the
    conversation exists and adds no turn.  Other columns are ignored.  An empty
    table has no nodes.  One conversation must fit into a task.

    The sketch has two cells for each turn and row, but no more than
    ``sketch_bytes`` of bits in all: beyond, more prefixes seem shared and are
    counted exactly with the others, which is slower and never wrong.
    """
    rows = written(chains(turns, conv_id, turn, role, text), "chains")
    n = rows.agg(F.sum(F.size("sizes"))).first()[0] or 0
    width = 1 << max(10, min(math.ceil(math.log2(2 * n + 1)), int(math.log2(sketch_bytes * 8 / DEPTH))))
    rows = written(screen(rows, width), "screened")
    met = written(rows.mapInPandas(_prefixes, _PREFIX), "prefixes")
    nodes = met.groupBy("digest").agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
                                      F.max("size").alias("size"), F.sum("tails").alias("tails"))
    nodes = written(nodes, "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("digest")).agg(F.count("*").alias("below"))
    nodes = written(nodes.join(children, "digest", "left").withColumn("n_children", F.col("tails") + F.coalesce("below", F.lit(0))).drop("tails", "below"), "nodes")
    # What each conversation owns: its nodes that may be shared, and its tail, which is one leaf and saves nothing.
    saved, leaf = (F.col("n_convs") - 1) * F.col("size"), (F.col("n_children") == 0).cast("long")
    owned = nodes.groupBy("conv").agg(F.sum(saved).alias("saved"), F.sum(leaf).alias("leaves"),
                                      F.array_sort(F.collect_list(F.struct("depth", saved.alias("saved"), leaf.alias("leaf")))).alias("own"))
    owned = written(rows.select("conv", (F.col("shared") < F.size("sizes")).cast("long").alias("tail")).join(owned, "conv", "left")
                    .select("conv", "tail", F.coalesce("saved", F.lit(0)).alias("saved"), (F.col("tail") + F.coalesce("leaves", F.lit(0))).alias("leaves"), "own"), "owned")
    sums = (met.select("digest", "conv").join(owned.where("saved <> 0 or leaves <> 0").select("conv", "saved", "leaves"), "conv")
            .groupBy("digest").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")))
    above = owned.where("own is not null").select("conv", F.posexplode("own").alias("k", "o"), "own").select(
        "conv", F.col("o.depth").alias("depth"),
        F.aggregate(F.slice("own", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda t, x: t + x["saved"]).alias("saved_above"),
        F.aggregate(F.slice("own", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda t, x: t + x["leaf"]).alias("leaves_above"))
    whole = _with_parent(nodes, nodes).join(sums, "digest", "left").join(above, ["conv", "depth"])
    whole = whole.join(ends_of(met.where("ended").select("digest", "conv")), "digest", "left")
    shared = whole.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
                          (F.coalesce("leaves", F.lit(0)) - F.col("leaves_above")).alias("n_leaves"),
                          (F.coalesce("saved", F.lit(0)) - F.col("saved_above")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))
    hangs = _with_parent(met.where("tails = 1").select(F.col("digest").alias("parent"), "conv"), nodes).drop("parent")
    alone = (rows.where(F.col("shared") < F.size("sizes")).select("conv", "sizes", "shared").join(hangs, "conv")
             .mapInPandas(_tails, "conv_id long, depth long, parent_conv_id long, n_children long, ends_sha256 string"))
    return shared.unionByName(alone.select("conv_id", "depth", "parent_conv_id", F.lit(1).cast("long").alias("n_convs"), "n_children",
                                           F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), "ends_sha256"))
