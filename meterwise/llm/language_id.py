"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled reference text.
Reading a document through it gives, at every place, the longest match with
the reference; the greedy parse cuts the document into as few such phrases as
possible.  Phrases per character times log2 of the reference's length estimates
the cross entropy, and the language with the smallest one wins.

A text of any length is cut into bounded columns that numpy steps through
together, all languages at once: the automaton's missing transitions are folded
into one table whose lowest bits say how many phrases ended here, and a step is
one gather.  The parse does not restart at a cut: columns first begin as if no
phrase were open, then those whose predecessor ended in another state begin
again from that, until all agree.  Greedy parses soon fall into step, so this
takes few passes; what does not settle is parsed through, one column a text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import written

UNDETERMINED = "und"
#: Symbols of a column.
BLOCK = 512
#: Columns that step together, and symbols they hold; bounds the memory of a task whatever the batch holds.
LANES, CELLS = 4096, 4096 * 512
#: Passes over columns that begin in another state than thought, before a text is parsed through.
PASSES = 8
#: Bound on the reference sample: texts per language, and symbols per text.
SAMPLE_TEXTS = 96
SAMPLE_SYMBOLS = 256
#: Distinct letters told apart, as many as a symbol's byte can name; rarer ones share a symbol.  Where so many
#: letters would make the table of all languages longer than this, fewer are, ``LEAST_LETTERS`` at least.
LETTERS, TABLE, LEAST_LETTERS = 253, 1 << 25, 62

_RESULT = "lang_pred string, score double, phrases array<long>"


@dataclass(frozen=True)
class Reference:
    """Labelled text per language (small, bounded by the sample parameters); pickled to the tasks."""

    languages: tuple[str, ...]
    texts: tuple[str, ...]


def reference(labelled: DataFrame, text: str = "text", lang: str = "lang", row_id: str = "doc_id",
              sample_texts: int = SAMPLE_TEXTS, sample_symbols: int = SAMPLE_SYMBOLS) -> Reference:
    """A bounded sample of labelled rows, the only thing learned from.

    Per language, the row with the smallest hash of its id in each of
    ``sample_texts`` hash buckets is taken, and of its words (runs of letters,
    lower-cased) the ``sample_symbols`` symbols that begin at a hashed place, so
    that any part of a long text may be learned from.  The cut is made before
    rows leave the executors: at most ``sample_texts`` x languages pieces reach
    the driver.  Of rows that repeat an id in a language, the smallest piece
    counts.  Rows without a language or a letter are not used; with nothing to
    learn from, every text is ``und``.  The list of picked ids is joined by its
    measured size.
    """
    rows = (labelled.where(F.col(lang).isNotNull() & F.col(row_id).isNotNull() & F.col(text).rlike(r"\p{L}"))
            .select(F.col(lang).alias("_lang"), F.col(row_id).alias("_id"), F.col(text).alias("_text")))
    hashed = rows.select("_lang", "_id", F.xxhash64("_id").alias("_hash"))
    picked = written(hashed.groupBy("_lang", F.pmod("_hash", F.lit(sample_texts)).alias("_bucket"))
                     .agg(F.min_by("_id", F.struct("_hash", "_id")).alias("_id")).select("_lang", "_id"), "picked")
    words = F.trim(F.regexp_replace(F.lower("_text"), r"\P{L}+", " "))
    place = F.pmod(F.xxhash64("_id", F.lit("place")), F.greatest(F.length("_words") - sample_symbols + 1, F.lit(1))).cast("int")
    pieces = (rows.join(picked, ["_lang", "_id"], "left_semi").select("_lang", "_id", words.alias("_words"))
              .groupBy("_lang", "_id").agg(F.min(F.substr("_words", place + 1, F.lit(sample_symbols))).alias("_piece")))
    found: dict[str, list[str]] = {}
    for row in sorted(pieces.collect(), key=lambda r: (str(r[0]), str(r[1]))):
        found.setdefault(row[0], []).append("".join(c if c.isalpha() else " " for c in row[2]))
    languages = tuple(sorted(found))
    return Reference(languages, tuple(" ".join(found[k]) for k in languages))


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transitions (states x width, 0: none) of the suffix automaton of ``symbols``; the start is state 1."""
    step: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in symbols:
        step.append({})
        length.append(length[last] + 1)
        link.append(1)
        cur, p = len(step) - 1, last
        while p and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                clone = len(step) - 1
                while p and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    out = np.zeros((len(step), width), np.int64)
    for s, moves in enumerate(step):
        for c, t in moves.items():
            out[s, c] = t
    return out


class Parser:
    """The automata of all languages as one table, and the alphabet."""

    def __init__(self, ref: Reference) -> None:
        seen: dict[str, int] = {}
        for text in ref.texts:
            for c in text:
                if c != " ":
                    seen[c] = seen.get(c, 0) + 1
        states = sum(2 * len(text) + 2 for text in ref.texts)
        told = min(LETTERS, max(LEAST_LETTERS, TABLE // max(1, states) - 2))
        letters = sorted(seen, key=lambda c: (-seen[c], c))[:told]
        self.languages = ref.languages
        self.width = len(letters) + 2  # 0: anything but a letter; 1: another letter
        code = {c: i + 2 for i, c in enumerate(letters)}
        points = np.arange(0x110000)
        self.is_letter = np.fromiter((chr(p).isalpha() for p in points), bool, len(points))
        self.symbol = self.is_letter.astype(np.uint8)
        for c, i in code.items():
            self.symbol[ord(c)] = i
        tables, self.root, base = [], [], 0
        for text in ref.texts:
            symbols = [code.get(c, 1) if c != " " else 0 for c in text]
            go = suffix_automaton(symbols, self.width)
            start = go[1]
            # No way on: the open phrase ends before this symbol and the next one begins with it.
            # A symbol that the language lacks is a phrase of its own.
            target = np.where(go > 0, go, np.where(start > 0, start, 1)[None, :])
            ended = (go == 0) * (1 + (start == 0)[None, :])
            ended[1] = start == 0  # at the start no phrase is open
            tables.append(((target * self.width + base) << 2 | ended).ravel())
            self.root.append(base + self.width)
            base += go.size
        self.table = np.concatenate(tables or [np.zeros(0, np.int64)]).astype(np.int32 if base < 2**29 else np.int64)
        self.root = np.array(self.root, self.table.dtype)
        self.bits = np.array([math.log2(max(2, len(t))) for t in ref.texts])

    def _walk(self, symbols: np.ndarray, at: np.ndarray, size: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases ended in each column of ``size`` symbols from ``at`` on and the state after it, begun in state ``start``; by language."""
        ended, after = np.zeros(start.shape, np.int64), np.empty_like(start)
        order = np.argsort(-size, kind="stable")
        lo = 0
        while lo < len(order):
            own = order[lo:lo + max(1, min(LANES, CELLS // max(1, int(size[order[lo]]))))]
            lo += len(own)
            a, n = at[own], size[own]
            columns = np.zeros((n[0], len(own)), np.uint8)
            for i in range(len(own)):
                columns[: n[i], i] = symbols[a[i]:a[i] + n[i]]
            alive = np.searchsorted(-n, -np.arange(n[0]), side="left")
            state = start[:, own]
            count = np.zeros(state.shape, np.int32)
            for k in range(n[0]):
                m = alive[k]
                moved = self.table[state[:, :m] + columns[k, :m]]
                count[:, :m] += moved & 3
                state[:, :m] = moved >> 2
            ended[:, own], after[:, own] = count, state
        return ended, after

    def phrases(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases per text and language; ``symbols`` holds the texts one after another."""
        first = np.cumsum(sizes) - sizes
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = first[owner] + part * BLOCK
        size = np.minimum(BLOCK, sizes[owner] - part * BLOCK)
        start = np.repeat(self.root[:, None], len(owner), axis=1)
        ended, after = self._walk(symbols, at, size, start)
        follows = np.flatnonzero(part > 0)
        for passes in range(PASSES + 1):
            begin = after[:, follows - 1]
            todo = (begin != start[:, follows]).any(axis=0)
            again, begin = follows[todo], begin[:, todo]
            if not len(again) or passes == PASSES:
                break
            start[:, again] = begin
            ended[:, again], after[:, again] = self._walk(symbols, at[again], size[again], begin)
        through = np.zeros((len(self.languages), len(sizes)), np.int64)
        final = np.repeat(self.root[:, None], len(sizes), axis=1)
        last = np.cumsum(blocks) - 1
        final[:, blocks > 0] = after[:, last[blocks > 0]]
        if len(again):  # from the first column that did not settle to the text's end
            texts, where = np.unique(owner[again], return_index=True)
            open_ = np.full(len(sizes), len(owner))
            open_[texts] = again[where]
            ended[:, np.arange(len(owner)) >= open_[owner]] = 0
            place = at[open_[texts]]
            through[:, texts], final[:, texts] = self._walk(symbols, place, first[texts] + sizes[texts] - place, begin[:, where])
        np.add.at(through, (slice(None), owner), ended)
        return (through + (final != self.root[:, None])).T

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        lowered = [(t or "").lower() for t in texts]
        sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.symbol[points]
        letters = np.concatenate([[0], np.cumsum(symbols > 0)])
        ends = np.cumsum(sizes)
        has_letter = (letters[ends] > letters[ends - sizes]) & bool(self.languages)
        if not has_letter.any():
            return pd.DataFrame({"lang_pred": UNDETERMINED, "score": 0.0, "phrases": [[0] * len(self.languages)] * len(texts)}, index=range(len(texts)))
        counts = self.phrases(symbols, sizes)
        entropy = counts * self.bits[None, :] / np.maximum(sizes, 1)[:, None]
        best = np.argmin(entropy, axis=1)
        inverse = 1 / np.maximum(entropy, 1e-9)
        score = inverse.max(axis=1) / inverse.sum(axis=1)
        names = np.array([*self.languages, UNDETERMINED], object)
        return pd.DataFrame({"lang_pred": names[np.where(has_letter, best, len(self.languages))],
                             "score": np.where(has_letter, score, 0.0), "phrases": list(counts)})


@lru_cache(maxsize=2)
def parser(ref: Reference) -> Parser:
    """Built once per Python worker."""
    return Parser(ref)


def language(text: Column, ref: Reference) -> Column:
    """struct<lang_pred, score, phrases> of a text.

    Null, empty and letterless texts are ``und`` with score 0; ties go to the
    first language in alphabetical order.  The score is the winner's share of
    the inverse entropies: 1 / languages for no evidence, towards 1.
    """
    @F.pandas_udf(_RESULT)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = parser(ref)
        for batch in batches:
            texts = batch.tolist()
            yield pd.concat([known.predict(texts[i:i + 512]) for i in range(0, len(texts), 512)] or [known.predict([])])

    return predicted(text)


def identify(docs: DataFrame, ref: Reference, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``phrases`` (replacing columns of those names)."""
    found = docs.withColumn("_language", language(F.col(text), ref))
    for name in ("lang_pred", "score", "phrases"):
        found = found.withColumn(name, F.col("_language")[name])
    return found.drop("_language")
