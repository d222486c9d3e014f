"""Benchmark decontamination by winnowing.

A text's k-gram hashes are read through windows of w consecutive ones, and
the smallest of each window (the last of equal ones) is kept as a fingerprint.
Two texts that share k + w - 1 consecutive words share such a window and so a
fingerprint; with k = 5 and w = 6 no shared span of ten words is missed.
Fingerprints of documents and benchmark are joined; a document gets the
items it meets with the places where they do, and each place is extended to
the whole shared span, compared word by word.  A document that meets more items
than a row should hold is compared with them in parts, and the spans united.

An item of fewer than ten words is one window; for each such length that
occurs, k and w are chosen so that k + w - 1 is that length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import PLAIN_WORDS, WordHasher, grams, written

WINDOW = 10
#: Fixed value: a word, after A-Z is lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = re.compile(WORD)
_LOWER = {i: i + 32 for i in range(65, 91)}
#: Documents hashed before their fingerprints are handed on.
CHUNK = 256
#: Bytes of item texts that one row may bring to a document; more are dealt into parts of about this size.
PART = 1 << 20

_SPANS = "array<struct<start:int,stop:int>>"
_RESULT = f"n_words long, n_hit long, items array<string>, spans {_SPANS}"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_LOWER))


def family(length: int, window: int = WINDOW) -> tuple[int, int]:
    """(k, w) with k + w - 1 = min(length, window)."""
    size = min(length, window)
    k = (size + 1) // 2
    return k, size - k + 1


def fingerprints(words: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the winnowed k-grams of a text's word hashes."""
    g = grams(words, k)
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64), g[:0]
    best, at = g[:n].copy(), np.arange(n)
    for i in range(1, w):
        lower = g[i:i + n] <= best
        best[lower] = g[i:i + n][lower]
        at[lower] = np.flatnonzero(lower) + i
    at = np.unique(at)
    return at, g[at]


def _table(docs: DataFrame, text: str, key: str, sizes: list[int] | None, window: int) -> DataFrame:
    """(key, size, place, hash) of each text: for the given window sizes, or for its own if None."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher(PLAIN_WORDS)
        for batch in batches:
            for lo in range(0, len(batch), CHUNK):
                part = batch.iloc[lo:lo + CHUNK]
                keys, size_, place, hash_ = [], [], [], []
                for key_, value in zip(part["_key"], part["_text"]):
                    words = hasher((value or "").encode("utf-8", "surrogatepass"))
                    for size in sizes if sizes is not None else ([min(window, len(words))] if len(words) else []):
                        at, found = fingerprints(words, *family(size, window))
                        keys.append(np.full(len(at), key_, object))
                        size_.append(np.full(len(at), size))
                        place.append(at)
                        hash_.append(found)
                if keys:
                    yield pd.DataFrame({"_key": np.concatenate(keys), "size": np.concatenate(size_).astype("int32"),
                                        "place": np.concatenate(place).astype("int32"), "hash": np.concatenate(hash_).view(np.int64)})

    return (docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
            .mapInPandas(rows, f"_key {docs.schema[key].dataType.simpleString()}, size int, place int, hash long"))


def _diagonals(own: np.ndarray, places: np.ndarray, theirs: np.ndarray, k: int, w: int) -> np.ndarray:
    """Offsets (place in the document less place in the item) at which the two share a fingerprint."""
    g = grams(own, k)
    places = np.unique(places[places < len(g)])
    places = places[np.argsort(g[places], kind="stable")]
    found = g[places]
    met = np.zeros(len(own) + len(theirs), bool)
    at, hashes = fingerprints(theirs, k, w)
    for p, lo, hi in zip(at, np.searchsorted(found, hashes, "left"), np.searchsorted(found, hashes, "right")):
        met[places[lo:hi] - p + len(theirs)] = True
    return np.flatnonzero(met) - len(theirs)


def _hits(words: list[str], met: list, window: int) -> tuple[np.ndarray, list[str]]:
    """Which words lie in a shared window, and the ids of the items that have one; ``met``: (item, text, places)."""
    hit = np.zeros(len(words), bool)
    items = set()
    hasher = WordHasher(PLAIN_WORDS)
    own = hasher(" ".join(words).encode("utf-8", "surrogatepass"))
    # Words are compared by number, not by hash.
    number: dict[str, int] = {}
    mine = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    for item, text, places in met:
        other = words_of(text)
        size = min(window, len(other))
        their = np.fromiter((number.get(w, -1) for w in other), np.int64, len(other))
        theirs = hasher(" ".join(other).encode("utf-8", "surrogatepass"))
        for d in _diagonals(own, np.asarray(places, np.int64), theirs, *family(len(other), window)).tolist():
            # Word d + i of the document stands beside word i of the item.
            lo, hi = max(0, -d), min(len(other), len(words) - d)
            same = np.zeros(hi - lo + 2, np.int8)
            same[1:-1] = their[lo:hi] == mine[d + lo:d + hi]
            runs = np.flatnonzero(np.diff(same)).reshape(-1, 2)
            for begin, end in runs[runs[:, 1] - runs[:, 0] >= size] + d + lo:
                hit[begin:end] = True
                items.add(item)
    return hit, sorted(items)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", row_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", window: int = WINDOW, part: int = PART) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (ids as sorted strings) and ``spans`` of hit words.

    Null and wordless texts have no words and no hits; an item without words has
    no window.  Rows repeating an item_id are one item; rows repeating a doc_id
    are judged each by its own text; rows without a doc_id as well (they look up
    the candidates of all such rows, and only true spans count).  Columns of
    ``docs`` that have the results' names are replaced, all others stay.  A row
    holds about ``part`` bytes of item texts at most, or one item.  The benchmark
    side is joined by its measured size: broadcast under Spark's threshold,
    else shuffled, where the skew join splits a passage that many documents share.
    """
    items = written(benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("item_text"))
                    .where(F.col("item_text").isNotNull()).distinct(), "items")
    marks = written(_table(items.select(F.xxhash64("item", "item_text").alias("k"), "item_text"),
                           "item_text", "k", None, window)
                    .select(F.col("_key").alias("k"), "size", "hash").distinct(), "item_marks")
    # At most ``window`` numbers.
    sizes = sorted(r[0] for r in marks.select("size").distinct().collect())
    # A null id is looked up under a value of its own, beside the ids as text.
    key = F.coalesce(F.concat(F.lit("="), F.col(row_id).cast("string")), F.lit(""))
    found = _table(docs.select(key.alias("_row"), F.col(text).alias("_value")).where(F.col("_value").isNotNull()), "_value", "_row", sizes, window)
    lookup = items.select(F.xxhash64("item", "item_text").alias("k"), "item", "item_text")
    met = written(found.join(marks, ["size", "hash"]).groupBy("_key", "k").agg(F.collect_set("place").alias("places"))
                  .join(lookup.select("k", F.octet_length("item_text").alias("bytes")), "k"), "met")
    # Documents that meet more than a row should hold; usually none.
    large = written(met.groupBy("_key").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > part)
                    .select("_key", F.ceil(F.col("bytes") / part).alias("_parts")), "large")
    number = F.pmod(F.xxhash64("k", F.lit("part")), F.coalesce("_parts", F.lit(1)))
    candidates = written(met.join(large, "_key", "left").withColumn("_part", number).join(lookup, "k").groupBy("_key", "_parts", "_part")
                         .agg(F.collect_list(F.struct("item", "item_text", "places")).alias("_met")), "candidates")

    @F.pandas_udf(_RESULT)
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher(PLAIN_WORDS)
        for texts, mets in batches:
            rows = []
            for value, met_ in zip(texts, mets):
                if met_ is None or not len(met_):
                    raw = np.frombuffer((value or "").encode("utf-8", "surrogatepass"), np.uint8)
                    rows.append((len(hasher.bounds(raw)[0]), 0, [], []))
                    continue
                words = words_of(value)
                hit, ids = _hits(words, [(m["item"], m["item_text"], m["places"]) for m in met_], window)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                spans = [{"start": int(a), "stop": int(b)} for a, b in edge.reshape(-1, 2)]
                rows.append((len(words), int(hit.sum()), ids, spans))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    @F.pandas_udf(_SPANS)
    def united(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for spans in batch:
                ends = sorted((s["start"], s["stop"]) for s in spans)
                whole: list[list[int]] = []
                for start, stop in ends:
                    if whole and start <= whole[-1][1]:
                        whole[-1][1] = max(whole[-1][1], stop)
                    else:
                        whole.append([start, stop])
                out.append([{"start": a, "stop": b} for a, b in whole])
            yield pd.Series(out, dtype=object)

    # The row travels as one struct, so that no column of it can clash.
    rows = docs.select(key.alias("_key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    value = F.coalesce(F.col("_row").getField(text).cast("string"), F.lit(""))
    few = candidates.where("_parts is null").select("_key", "_met")
    if large.limit(1).count() == 0:
        judged_ = rows.join(few, "_key", "left").select("_row", judged(value, F.col("_met")).alias("_judged"))
    else:
        one = (rows.join(large, "_key", "left_anti").join(few, "_key", "left")
               .select("_row", judged(value, F.col("_met")).alias("_judged")))
        many = rows.join(large.select("_key"), "_key", "left_semi").withColumn("_value", value)
        found_ = (many.select("_key", "_value").distinct().join(candidates.where("_parts is not null"), "_key")
                  .select("_key", "_value", judged(F.col("_value"), F.col("_met")).alias("j"))
                  .groupBy("_key", "_value").agg(F.max("j.n_words").alias("n_words"), F.flatten(F.collect_list("j.items")).alias("items"),
                                                 F.flatten(F.collect_list("j.spans")).alias("spans"))
                  .withColumn("spans", united("spans")))
        n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]))
        found_ = found_.select("_key", "_value", F.struct("n_words", n_hit.alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"),
                                                          "spans").alias("_judged"))
        judged_ = one.unionByName(many.join(found_, ["_key", "_value"]).select("_row", "_judged"))
    names = ["n_words", "n_hit", "items", "spans"]
    columns = [*docs.columns, *(n for n in names if n not in docs.columns)]
    return judged_.select(*(F.col("_judged" if c in names else "_row").getField(c).alias(c) for c in columns))
