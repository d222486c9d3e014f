"""Spelling variants by a relational trie: words one edit apart, found by joining a frontier with a table of edges.

The vocabulary is a trie kept as a table of edges ``(node, c, label, child)``.
Runs of nodes without a branch are one edge, whose label holds their letters; an
empty label ends a word.  A node is the 64-bit hash of its prefix.

One edit leaves the first or the second half of a word as it was, so there are
two tries, of the words and of the reversed words, and edits are only made
behind the middle.  A word's own path is known, so its states without an edit
are its branching nodes; joined with the edges that leave the path, they become
states with one edit (word, position, node, edited word).  These follow the
edges level by level, and a state that ends a word is a neighbour.  Only the
live frontier moves; no two words are paired but by a shared node.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.llm.common import MASK, WORD_BASE, _powers, mixed, written

RUNS = "[A-Za-zÀ-ÿ]+"
#: Words handed to numpy at once (their letters are one array).
WORDS_AT_ONCE = 20000


def noisy_runs(docs: DataFrame, noise: int | None, doc_id: str, text: str) -> DataFrame:
    """One row (word) per run of letters, A-Z lower-cased; a run whose hash with its document ``noise`` divides loses a letter."""
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUNS), F.lit(0))).alias("w"))
    runs = runs.select("d", F.translate("w", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("w"))
    if noise is None:
        return runs.select(F.col("w").alias("word"))
    runs = runs.select("w", F.crc32(F.concat_ws(":", "d", "w").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("w")).cast("int")
    return runs.select(F.when(F.col("h") % noise != 0, F.col("w")).otherwise(F.concat(F.col("w").substr(F.lit(1), at), F.expr("substring(w, cast(h % char_length(w) as int) + 2)")))
                       .alias("word"))


def vocabulary(docs: DataFrame, min_length: int = 5, min_count: int = 3, noise: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, word, n) of the words long and frequent enough, written once so that ids stay."""
    counts = noisy_runs(docs, noise, doc_id, text).groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") >= min_count) & (F.char_length("word") >= min_length))
    return written(counts.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def _paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, way, pos, node, next): the nodes of each word from just before its middle on, in both directions; next -1 ends the word."""
    for batch in batches:
        for i in range(0, len(batch), WORDS_AT_ONCE):
            part = batch.iloc[i:i + WORDS_AT_ONCE]
            ids, size = part["id"].to_numpy(), part["word"].str.len().to_numpy()
            first = np.cumsum(size) - size
            up, down = _powers(WORD_BASE, int(size.sum()) + 1), _powers(pow(WORD_BASE, -1, MASK + 1), int(size.sum()) + 1)
            low = (size - 1) // 2
            many = size - low + 1
            row = np.repeat(np.arange(len(part)), many)
            pos = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + low[row]
            for way in (0, 1):
                words = part["word"] if way == 0 else part["word"].str[::-1]
                codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)], dtype=np.uint64)])
                at = first[row] + pos
                node = mixed((total[at] - total[first[row]]) * down[first[row]] + pos.astype(np.uint64) * np.uint64(2) + np.uint64(way))
                ends = pos == size[row]
                after = np.where(ends, -1, codes[np.minimum(at, max(len(codes) - 1, 0))].astype(np.int64))
                yield pd.DataFrame({"id": ids[row], "way": np.int8(way), "pos": pos.astype(np.int32), "node": node.view(np.int64), "next": after.astype(np.int32)})


def trie(words: DataFrame) -> DataFrame:
    """(id, word, way, pos, node, c, label, child): each word's branching nodes from its middle on, and the edge it takes from each.

    ``word`` is reversed where ``way`` is 1; ``c`` is the label's first letter,
    both empty where the word ends; ``child`` is null where the label ends it.
    """
    nodes = words.select("id", "word").mapInPandas(_paths, "id long, way byte, pos int, node long, next int")
    same = Window.partitionBy("node")
    branching = nodes.withColumns({"lo": F.min("next").over(same), "hi": F.max("next").over(same)}).where("lo < hi").select("id", "way", "pos", "node")
    along = Window.partitionBy("id", "way").orderBy("pos")
    steps = branching.withColumns({"to": F.lead("pos").over(along), "child": F.lead("node").over(along)}).join(words.select("id", "word"), "id")
    steps = steps.withColumn("word", F.when(F.col("way") == 1, F.reverse("word")).otherwise(F.col("word")))
    label = F.col("word").substr(F.col("pos") + 1, F.coalesce(F.col("to"), F.char_length("word")) - F.col("pos"))
    return steps.select("id", "word", "way", "pos", "node", F.col("word").substr(F.col("pos") + 1, F.lit(1)).alias("c"), label.alias("label"), "child")


def _follows(target: Column, pos: Column, label: Column) -> Column:
    return target.substr(pos + 1, F.char_length(label)) == label


def neighbours(words: DataFrame) -> DataFrame:
    """(id, other): each pair of words that differ by exactly one inserted, deleted or replaced letter, in both orders."""
    paths = written(trie(words), "paths")
    edges = paths.select("node", "c", "label", "child").distinct()
    ahead = paths.select(F.col("node").alias("child"), "c").distinct().groupBy("child").agg(F.collect_set("c").alias("ahead"))
    # ahead: the letters that follow a child, one alphabet at most; edges that end a word have none and stay out of the shuffle
    edges = written(edges.where("child is not null").join(ahead, "child").select("node", "c", "label", "child", "ahead")
                    .unionByName(edges.where("child is null").withColumn("ahead", F.lit(None).cast("array<string>"))), "edges")
    # The longer word of a pair is found from the shorter, and of equally long words the one with the larger letter from the other.
    # An insertion before an equal letter is the same as one behind it, so the inserted letter differs from the next.
    middle = F.when(F.col("way") == 0, F.floor(F.char_length("word") / 2)).otherwise(F.ceil(F.char_length("word") / 2))
    own = paths.where(F.col("pos") >= middle).select("id", "word", "way", "pos", "node", F.col("c").alias("own"))
    off = own.join(edges, "node").where("c <> own and c <> ''")
    head = F.expr("substring(word, 1, pos)")
    kinds = F.array(F.when((F.col("own") != "") & (F.col("c") > F.col("own")), F.concat(head, F.col("c"), F.expr("substring(word, pos + 2)"))),
                    F.concat(head, F.col("c"), F.expr("substring(word, pos + 1)")))
    states = off.select("id", "way", "pos", "label", "child", "ahead", F.explode(kinds).alias("target")).where("target is not null")
    rounds = []
    while True:
        moved = states.where(_follows(F.col("target"), F.col("pos"), F.col("label"))).withColumn("pos", F.col("pos") + F.char_length("label"))
        goes_on = F.array_contains("ahead", F.expr("substring(target, pos + 1, 1)"))
        moved = moved.where(F.when(F.col("child").isNull(), F.char_length("target") == F.col("pos")).otherwise(goes_on))
        rounds.append(written(moved.select("id", "way", "pos", "child", "target"), "frontier"))
        live = rounds[-1].where("child is not null").withColumnRenamed("child", "node").withColumn("c", F.expr("substring(target, pos + 1, 1)"))
        if live.isEmpty():
            break
        states = live.join(edges, ["node", "c"])
    ended = reduce(DataFrame.unionByName, rounds).where("child is null")
    pairs = (ended.select("id", F.when(F.col("way") == 1, F.reverse("target")).otherwise(F.col("target")).alias("word"))
             .join(words.select("word", F.col("id").alias("other")), "word").select("id", "other").distinct())
    return pairs.select(F.explode(F.array(F.struct("id", "other"), F.struct(F.col("other").alias("id"), F.col("id").alias("other")))).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word with a form, follow forms to the last; each round doubles the step, and counts at least double along a chain."""
    last = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = last.join(last.select(F.col("word").alias("root"), F.col("root").alias("far")), "root", "left")
        after = written(step.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        last = after.select("word", "root")
        if after.where("moved").isEmpty():
            return last


def variant_groups(docs: DataFrame, min_length: int = 5, min_count: int = 3, ratio: int = 2, noise: int | None = None,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of the texts: word, n, n_near, form, form_n, root.

    A word is a run of letters (A-Z lower-cased) of at least ``min_length``
    code points that occurs at least ``min_count`` times in all.  Its form is
    its neighbour of largest n (ties: smallest in code-point order) if that n is
    at least ``ratio`` (2 or more) times its own; root is the end of the chain of forms.

    Null and empty texts have no words, a null ``doc_id`` counts as an empty
    one, repeated rows count each time, columns but the two named are ignored,
    and an empty table gives no rows.  Very long runs are words like any other;
    their cost grows in proportion to their length.
    """
    if ratio < 2:
        raise ValueError("counts must at least double from a word to its form")
    words = vocabulary(docs, min_length, min_count, noise, doc_id, text)
    near = neighbours(words).join(words.select(F.col("id").alias("other"), F.col("word").alias("v"), F.col("n").alias("m")), "other")
    best = near.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "v")).alias("best"))
    formed = F.col("best").isNotNull() & (-F.col("best.m") >= ratio * F.col("n"))
    rows = written(words.join(best, "id", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best.v")).alias("form"),
                                                         F.when(formed, -F.col("best.m")).alias("form_n")), "forms")
    return rows.join(roots(rows.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))
