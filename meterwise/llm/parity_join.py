"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles.  Its sketch has, for each
of B blocks, the exclusive or of the hashes of the shingles that fall into the
block: a linear sketch, so two documents' sketches differ in at most as many
blocks as their sets differ in shingles.  At similarity J the difference D of
sizes a <= b is at most (1 - J) / (1 + J) (a + b), which is at most (1/J - 1) a
from the smaller side.  So of the non-empty blocks of either, at most D differ,
and (pigeonhole) of its first D + r in a common order at least r are equal.
B depends on the size band, and a document near a band's lower end is also
sketched as one of the band below.

Equal blocks are found by one shuffle of these leading blocks, packed: a chunk
of documents sends one row per range of block keys, with 32 bits of each key and
one byte that says whose it is; a key met twice within the chunk is settled
there and sent once.  What comes back is a list of hits.  Documents with fewer
equal blocks than r cannot have a partner and leave.  Of the others all
blocks are compared: at least N - D of a document's N must be equal to some
partner's, which a passage that many documents share doesn't reach; and of the
equal ones each document needs only its rarest to meet its partners (prefix
filter).  Candidates whose short bit sketches (one bit toggled per shingle)
are farther apart than D (their Hamming distance is at most the difference) go,
and the rest are verified on the sets themselves.

Only classes are asked for, so candidates are stars: each holder of a block is
verified with the block's most central holder, the one whose blocks are held by
most others (the text that a family of copies was made from is nearer to each
of them than they are to each other); afterwards, pairs that share a block but
are still in different classes are verified as well.  No link between classes
is lost and no group is paired all with all.

A set is told by a 64-bit hash of its shingles, not by its document's id, so rows
that repeat an id with other texts are sets of their own.  Texts are never
shuffled: which documents a look concerns is a bit table of hashed ids of bounded
size, whose false hits only cost time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.llm.common import SPACED_WORDS, WordHasher, components, cut, grams, mixed, release, written

SHINGLE = 5
#: Similarity of a link, in hundredths.
PERCENT = 75
#: Sizes up to this have one block per shingle; further bands are four times as wide each.
FIRST_BAND = 64
#: Of the blocks beyond D, one is emitted per so many shingles; so many must be equal.
SPARE = 16
#: 64-bit words of the short bit sketch.
SKETCH_WORDS = 16
CHUNK = 256
#: Documents whose leading blocks travel together; the last value of a byte means no document.
TOGETHER = 255
#: Leading blocks in a range of keys, about.
RANGE = 1 << 20
#: Bits of a table of ids for each id, and in all.
BITS_PER_ID, MOST_BITS = 64, 1 << 27


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text's word hashes; fewer words than ``size`` are one shingle."""
    if not len(words):
        return words
    return np.unique(grams(words, min(size, len(words))))


def slack(size: int, percent: int = PERCENT) -> int:
    """Largest difference a set of this size can have to a partner."""
    return size * (100 - percent) // percent


def spare(size: int) -> int:
    return max(1, size // SPARE)


def needed(size: int, percent: int = PERCENT) -> int:
    """Equal blocks that a document must have with some partner, whatever the partner's size."""
    return spare(-(-size * percent // 100))


def bands(size: int, percent: int = PERCENT) -> list[int]:
    """The document's band and, where a partner can be in it, the one below (0: up to FIRST_BAND)."""
    def of(n: int) -> int:
        return 0 if n <= FIRST_BAND else math.ceil(math.log(n / FIRST_BAND, 4) - 1e-12)

    own, low = of(size), of(max(1, -(-size * percent // 100)))
    return [own] if own == low else [own, low]


def blocks(hashes: np.ndarray, band: int) -> np.ndarray:
    """Keys of the non-empty blocks of the sketch for a band, in the order common to all documents."""
    h = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D + band))
    if not band:
        return np.sort(h)
    block = h % np.uint64(FIRST_BAND * 4 ** band)
    order = np.argsort(block, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(block[order]) != 0]))
    content = np.bitwise_xor.reduceat(mixed(h[order] + np.uint64(band)), first)
    return mixed(content ^ mixed(block[order][first] + np.uint64(1)))


def bit_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall on each of 64 * SKETCH_WORDS bits."""
    odd = np.bincount((mixed(hashes + np.uint64(7)) % np.uint64(64 * SKETCH_WORDS)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_id(s: np.ndarray) -> int:
    """A set's 64-bit hash."""
    return int(np.bitwise_xor.reduce(mixed(s)).view(np.int64)) if len(s) else 0


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(_id, n, set) of each document: its set's size and hash."""
    @F.pandas_udf("n long, set long")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release()
        hasher = WordHasher(SPACED_WORDS)
        for batch in batches:
            found = [shingles(hasher((text or "").encode("utf-8", "surrogatepass")), size) for text in batch]
            yield pd.DataFrame([(len(s), set_id(s)) for s in found], columns=["n", "set"])

    return docs.withColumn("_set", digest("_text")).select("_id", "_set.*")


def _listed(ids: DataFrame) -> DataFrame:
    """(word, bits): a bit table of the ids, ``BITS_PER_ID`` bits each and no more than ``MOST_BITS`` in all."""
    n = max(1, ids.count())
    width = 1 << max(6, min(math.ceil(math.log2(n * BITS_PER_ID)), MOST_BITS.bit_length() - 1))
    at = F.xxhash64("_id").bitwiseAND(width - 1)
    return (written(ids.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
                    .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")), "listed").withColumn("width", F.lit(width).cast("long")))


def _kept(rows: DataFrame, table: DataFrame, without: bool = False) -> DataFrame:
    """The rows whose id is listed, and some whose hash falls on a listed one's, or (``without``) all others; the table's words are at most ``MOST_BITS`` / 64."""
    width = table.select("width").first()
    if width is None:
        return rows if without else rows.where("false")
    at = F.xxhash64("_id").bitwiseAND(width[0] - 1)
    met = rows.withColumn("_at", at).join(F.broadcast(table.select("word", "bits")), F.shiftright("_at", 6) == F.col("word"), "left" if without else "inner")
    hit = F.expr("coalesce(bits & shiftleft(1L, cast(_at & 63 as int)), 0L) <> 0")
    return met.where(~hit if without else hit).select(*rows.columns)


def split_by(rows: DataFrame, ids: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows that may be named by ``ids``, rows that are not), without a shuffle: only the first need an exact join."""
    table, known = _listed(ids.select(F.col(column).alias("_id"))), rows.withColumn("_id", F.col(column))
    return _kept(known, table).drop("_id"), _kept(known, table, without=True).drop("_id")


_PACKED = "range int, chunk long, keys binary, whose binary, sets binary, needs binary, hits binary"


def _leading(batches: Iterator[pd.DataFrame], size: int, percent: int, bits: int) -> Iterator[pd.DataFrame]:
    """The first D + r blocks of each text in its bands, packed by ``TOGETHER`` documents and 2 ** ``bits`` ranges of keys.

    A header row (hits not null) has the chunk's sets, what each needs, and its
    hits within the chunk; it travels with one of the ranges.
    """
    from pyspark import TaskContext

    release()
    hasher, task, count = WordHasher(SPACED_WORDS), TaskContext.get().partitionId(), 0
    for batch in batches:
        for lo in range(0, len(batch), TOGETHER):
            sets, needs, keys, whose = [], [], [], []
            for value in batch["_text"].iloc[lo:lo + TOGETHER]:
                s = shingles(hasher(value.encode("utf-8", "surrogatepass")), size)
                for band in bands(len(s), percent) if len(s) else []:
                    k = blocks(s, band)[: slack(len(s), percent) + spare(len(s))]
                    keys.append(k)
                    whose.append(np.full(len(k), len(sets), np.uint8))
                if len(s):
                    sets.append(set_id(s))
                    needs.append(needed(len(s), percent))
            if not sets:
                continue
            key, owner = np.concatenate(keys), np.concatenate(whose)
            order = np.argsort(key, kind="stable")
            key, owner = key[order], owner[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            again = ~first | np.concatenate([~first[1:], [False]])  # met twice or more within the chunk
            hits = owner[again]
            key, owner = key[first], np.where(again, np.uint8(TOGETHER), owner)[first]
            of = (key >> np.uint64(64 - bits)).astype(np.int64)
            edge = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
            low = (key >> np.uint64(32 - bits)).astype(np.uint32)
            chunk = task << 32 | count
            count += 1
            rows = [(int(of[i]), chunk, low[i:j].tobytes(), owner[i:j].tobytes(), None, None, None) for i, j in zip(edge[:-1], edge[1:])]
            rows.append((chunk % (1 << bits), chunk, None, None, np.array(sets, np.int64).tobytes(), np.array(needs, np.int32).tobytes(), hits.tobytes()))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _PACKED.split(", ")])


_HITS = "chunk long, sets binary, needs binary, hits binary"


def _met(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one range, each chunk's hits: the documents of the keys that another chunk has as well.  Header rows pass through."""
    head = frame["hits"].notna().to_numpy()
    out, rows = [frame[head][["chunk", "sets", "needs", "hits"]]], frame[~head]
    if len(rows):
        parts = [np.frombuffer(k, np.uint32) for k in rows["keys"]]
        key = np.concatenate(parts)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        found, at = [], 0
        for chunk, whose in zip(rows["chunk"], rows["whose"]):
            whose = np.frombuffer(whose, np.uint8)
            hits = whose[twice[at:at + len(whose)] & (whose != TOGETHER)]
            at += len(whose)
            if len(hits):
                found.append((chunk, None, None, hits.tobytes()))
        out.append(pd.DataFrame(found, columns=["chunk", "sets", "needs", "hits"]))
    return pd.concat(out)


def _enough(frame: pd.DataFrame) -> pd.DataFrame:
    """(set) of one chunk's documents that have as many equal blocks as they need."""
    head = frame[frame["sets"].notna()].iloc[0]
    sets, needs = np.frombuffer(head["sets"], np.int64), np.frombuffer(head["needs"], np.int32)
    hits = np.bincount(np.frombuffer(b"".join(frame["hits"]), np.uint8), minlength=len(sets))[:len(sets)]
    return pd.DataFrame({"set": sets[hits >= needs]})


def packed(s: np.ndarray) -> bytes:
    """The upper 48 bits of each hash of a set, 6 bytes each and sorted."""
    return np.unique(s >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _hashed(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """(set, n, hashes, bits) of each text that has shingles."""
    release()
    hasher = WordHasher(SPACED_WORDS)
    for batch in batches:
        for lo in range(0, len(batch), CHUNK):
            found = [shingles(hasher(t.encode("utf-8", "surrogatepass")), size) for t in batch["_text"].iloc[lo:lo + CHUNK]]
            found = [s for s in found if len(s)]
            yield pd.DataFrame({"set": [set_id(s) for s in found], "n": [len(s) for s in found], "hashes": [packed(s) for s in found],
                                "bits": [bit_sketch(s) for s in found]})


def _all_blocks(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """(id, band, need, key) of all blocks: of N blocks, at least N - D are equal to a partner's."""
    for batch in batches:
        for lo in range(0, len(batch), CHUNK):
            rows = []
            for key, value in zip(batch["id"].iloc[lo:lo + CHUNK], batch["hashes"].iloc[lo:lo + CHUNK]):
                s = unpacked(value)
                for band in bands(len(s), percent):
                    k = blocks(s, band)
                    rows.append((np.full(len(k), key), np.full(len(k), band, np.int32),
                                 np.full(len(k), max(1, len(k) - slack(len(s), percent)), np.int32), k.view(np.int64)))
            if rows:
                yield pd.DataFrame(dict(zip(("id", "band", "need", "key"), map(np.concatenate, zip(*rows)))))


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*(prefix + c for c in df.columns))


def _near(x: str, y: str, percent: int) -> Column:
    """Whether the bit sketches are no farther apart than sets of these sizes may be."""
    distance = sum((F.bit_count(F.col(f"{x}bit{i}").bitwiseXOR(F.col(f"{y}bit{i}"))) for i in range(SKETCH_WORDS)), F.lit(0))
    return distance * (100 + percent) <= (F.col(f"{x}n") + F.col(f"{y}n")) * (100 - percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            x, y = unpacked(x), unpacked(y)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
    return cut(pairs.join(left, "a").join(right, "b").where(similar("ha", "hb")).select("a", "b"))


def jaccard_classes(docs: DataFrame, text: str = "text", row_id: str = "doc_id", size: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: set size, and the smallest id reachable by links.

    Two documents link when 100 * intersection >= ``percent`` * union.  Null,
    empty and wordless texts have an empty set and link with nothing, not even
    each other.  Equal texts are one class whatever their number.  Rows that
    repeat a doc_id, with one text or with several, are each returned with their own text's class; a row without an id is never
    a class's smallest id and has itself no class (null component_id) unless it
    equals a document that has one.
    """
    rows = docs.select(F.col(row_id).alias("_id"), F.col(text).alias("_text"))
    digests = written(_sets(rows, size), "set_digests")
    # Equal sets are one: the smallest id stands for them.
    same = written(digests.where("n > 0").groupBy("set").agg(F.min("_id").alias("id")).where("id is not null"), "sets_once")
    stands = written(digests.join(same, "set", "left").select("_id", "n", "set", "id"), "set_classes")
    texts = rows.where(F.col("_text").isNotNull() & F.col("_id").isNotNull())
    standing = stands.where("_id = id").select("_id", "set")

    # First look: the leading blocks of all that stand for a set.
    total = digests.agg(F.sum("n")).first()[0] or 0
    bits = min(20, max(3, math.ceil(math.log2(max(1, total / 2) / RANGE))))
    hits = (_kept(texts, _listed(standing)).mapInPandas(lambda batches: _leading(batches, size, percent, bits), _PACKED)
            .groupBy("range").applyInPandas(_met, _HITS))
    likely = written(hits.groupBy("chunk").applyInPandas(_enough, "set long").distinct(), "likely")

    # Second look: the sets and all blocks of the few that are left.
    sets = written(_kept(texts, _listed(standing.join(likely, "set").select("_id")))
                   .mapInPandas(lambda batches: _hashed(batches, size), "set long, n long, hashes binary, bits array<long>")
                   .withColumn("id", F.monotonically_increasing_id()), "sets")
    copies = written(sets.groupBy("set").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    if not copies.isEmpty():
        sets = written(sets.join(copies, "set", "left").where("first is null or id = first").drop("first"), "sets")
    every = sets.select("id", "hashes").mapInPandas(lambda batches: _all_blocks(batches, percent), "id long, band int, need int, key long")
    by_key, by_band = Window.partitionBy("key"), Window.partitionBy("id", "band")
    shared = every.withColumn("others", F.count("*").over(by_key)).where("others > 1")
    ranked = (shared.withColumn("met", F.count("*").over(by_band)).where("met >= need")
              .withColumn("central", F.round(F.sum(F.log("others")).over(by_band) / F.col("need"), 6))
              .withColumn("rank", F.row_number().over(by_band.orderBy("others", "key"))))
    leads = (ranked.where("rank <= met - need + 1").select("id", "key", "central")
             .withColumn("lead", F.min(F.struct(-F.col("central"), F.col("id").alias("id"))).over(by_key)["id"])
             .withColumn("others", F.count("*").over(by_key)).where("others > 1"))
    prefix = written(leads.select("id", "key", "lead"), "rarest_blocks")
    info = sets.select("id", "n", *(F.col("bits")[i].alias(f"bit{i}") for i in range(SKETCH_WORDS)))

    first = prefix.where("id <> lead").select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()
    near = (first.join(_renamed(info, "x_"), F.col("a") == F.col("x_id")).join(_renamed(info, "y_"), F.col("b") == F.col("y_id"))
            .where(_near("x_", "y_", percent)).select("a", "b"))
    stars = _verified(near, sets, percent)
    label = components(stars)

    # Blocks whose holders are not yet one class: those outside the lead's class meet all of other classes.
    held = cut(prefix.join(label, "id", "left").select("key", "id", "lead", F.coalesce("component", "id").alias("c"))
               .withColumn("lead", F.max(F.when(F.col("id") == F.col("lead"), F.col("c"))).over(by_key))
               .withColumn("open", F.max(F.col("c") != F.col("lead")).over(by_key)).where("open").drop("open"))
    full = held.join(info, "id")
    odd = _renamed(full.where("c <> lead"), "x_")
    once = (F.col("y_c") == F.col("y_lead")) | (F.col("x_c") < F.col("y_c"))
    rest = (odd.join(_renamed(full, "y_"), (F.col("x_key") == F.col("y_key")) & (F.col("x_c") != F.col("y_c")) & once & _near("x_", "y_", percent))
            .select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()
            .join(first, ["a", "b"], "left_anti"))
    links = stars.unionByName(_verified(rest, sets, percent))
    final = components(links)
    # A class is named by the smallest document id of its sets.
    sets_of = final.join(sets.select("id", "set"), "id").select("set", "component").join(same, "set")
    named = written(sets_of.join(sets_of.groupBy("component").agg(F.min("id").alias("class")), "component").select("set", "class"), "classes")
    return (stands.join(named, "set", "left")
            .select(F.col("_id").alias(row_id), F.col("n").alias("n_shingles"), F.coalesce("class", "id", "_id").alias("component_id")))
