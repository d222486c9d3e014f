"""Packing documents into training sequences: best-fit start, then swap-based local search.

Documents are tokenised, closed with one end id, and only those longer than a
sequence are cut.  Pieces are dealt by hash into groups of a bounded number;
each group is packed by itself: best fit, longest first, then a local search
that moves a document, or exchanges one for one or one for two, between
underfull bins.  A change is made only if it raises the sum of squared fills,
so fuller bins grow at the cost of emptier ones until bins empty, and the search
ends where no change raises it.  Bins that stay underfull are dissolved and dealt
anew, into fewer groups where they can be, as long as that saves sequences; no
piece or group ever goes through the driver.
"""

from __future__ import annotations

import bisect
import json
import math
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import written
from meterwise.llm.token_counts import PairMerger, byte_letters

CAPACITY = 4096
#: Id that closes each document.
END_ID = 1
#: Pieces a group has on average; one group is packed in one task.
GROUP = 4096
#: Bins at least this full are kept as they are when groups are merged.
FULL = 0.995
#: Underfull bins are dealt anew while that saves more than this share of them (of few bins, while it saves any).
SAVED = 0.001
#: Units (text between spaces) remembered per Python worker.
REMEMBERED = 600_000
CHUNK = 256


# -- tokens ----------------------------------------------------------------

class Encoder:
    """Ids of texts under a tokenizer that drops white space.

    Such a tokenizer gives each unit (a run without space or line feed) the
    same ids wherever it stands, so ids are remembered per unit.  Units of plain
    Latin text that are new are merged together as arrays where the file is
    of the known shape; all others are given to the tokenizers library.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[str, bytes] = {}
        normal, pre = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
        names = [n["type"] for n in normal.get("normalizers", [])]
        cuts = pre.get("pretokenizers", [{}])
        if names != ["NFC", "Replace", "Lowercase"] or [p.get("type") for p in cuts] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: not a tokenizer that drops white space")
        ids, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.merger = PairMerger(spec["model"])
        self.inner = np.array([ids[c] for c in byte_letters()], np.int64)
        self.final = np.array([ids[c + suffix] for c in byte_letters()], np.int64)
        self.cut = regex.compile(cuts[0]["pattern"]["Regex"])
        marks = "|".join(regex.escape(t["content"]) for t in spec["added_tokens"])
        #: Characters whose case and composition Python and the library treat alike.
        self.plain = regex.compile(rf"(?!.*(?:{marks}))[!-~À-į]+" if marks else r"[!-~À-į]+")
        #: Whether a run of ASCII letters is one piece and cannot hold an added token; most units are such runs.
        self.whole = r"|[\p{L}]+|" in self.cut.pattern and not any(t["content"].isalpha() for t in spec["added_tokens"])

    def _is_plain(self, unit: str) -> bool:
        if unit.isascii():
            return self.whole and unit.isalpha() or self.plain.fullmatch(unit) is not None
        return self.plain.fullmatch(unit) is not None and unicodedata.is_normalized("NFC", unit)

    def _merge(self, units: list[str]) -> None:
        lowered = [u.lower() for u in units]
        pieces = [[u] if self.whole and u.isalpha() and u.isascii() else self.cut.findall(u) for u in lowered]
        raw = [t.encode() for p in pieces for t in p]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[data]
        sym[np.cumsum(size) - 1] = self.final[data[np.cumsum(size) - 1]]
        ids, token = self.merger.merge(sym, np.repeat(np.arange(len(raw)), size))
        owner = np.repeat(np.arange(len(units)), np.fromiter(map(len, pieces), np.int64, len(pieces)))
        ends = (np.searchsorted(owner[token], np.arange(len(units)), side="right") * 4).tolist()
        self._remember(units, ids.astype("<u4").tobytes(), ends)

    def _remember(self, units: list[str], ids: bytes, ends: list[int]) -> None:
        at = 0
        for unit, end in zip(units, ends):
            self.known[unit] = ids[at:end]
            at = end

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, without special ids added."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        self.known[""] = b""
        units = [t.replace("\n", " ").split(" ") for t in texts]
        new = list(set().union(*units).difference(self.known))  # looks up the new ones only; ``- keys()`` would walk all that is known
        plain = list(filter(self._is_plain, new))
        if plain:
            self._merge(plain)
        other = [u for u in new if u not in self.known]
        for unit, found in zip(other, self.library.encode_batch(other, add_special_tokens=False)):
            self.known[unit] = np.array(found.ids, "<u4").tobytes()
        of = self.known.__getitem__
        return [b"".join(map(of, u)) for u in units]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """Read once per Python worker, from a path that every executor has."""
    return Encoder(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut only beyond ``capacity``.

    A null text counts as empty and has the end id alone.  Rows that repeat a
    doc_id each have pieces of their own.
    """
    last = np.array([END_ID], "<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            for lo in range(0, len(batch), CHUNK):
                part = batch.iloc[lo:lo + CHUNK]
                rows = []
                for key, ids in zip(part["_id"], encode([t or "" for t in part["_text"]])):
                    ids += last
                    rows += [(key, i, i * capacity, len(p) // 4, zlib.crc32(p))
                             for i, p in enumerate(ids[at:at + width] for at in range(0, len(ids), width))]
                out = pd.DataFrame(rows, columns=["_id", "piece", "start", "length", "ids_crc32"])
                yield out.astype({"_id": part["_id"].dtype})

    id_type = docs.schema[row_id].dataType.simpleString()
    return (docs.select(F.col(row_id).alias("_id"), F.col(text).alias("_text"))
            .mapInPandas(cut, f"_id {id_type}, piece int, start long, length long, ids_crc32 long")
            .withColumnRenamed("_id", row_id))


# -- packing of one group --------------------------------------------------

def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of indexes): longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (room left, bin), sorted
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect.bisect_left(room, (sizes[i], -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        bisect.insort(room, (left - sizes[i], b))
    return bins


class _Bins:
    """Bins under local search; their documents in one array sorted by (bin, size), so that the best partner is a binary search."""

    def __init__(self, bins: list[list[int]], sizes: list[int], capacity: int) -> None:
        self.sizes, self.capacity, self.base = sizes, capacity, capacity + 1
        of = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        docs = np.array([i for b in bins for i in b], np.int64)
        key = of * self.base + np.array(sizes, np.int64)[docs]
        order = np.argsort(key, kind="stable")
        self.key, self.docs = key[order], docs[order]
        self.fill = np.bincount(of, np.array(sizes, np.int64)[docs], len(bins)).astype(np.int64)
        #: When a bin last changed, and when it last found nothing to give.
        self.clock, self.changed, self.tried = 1, np.ones(len(bins), np.int64), np.zeros(len(bins), np.int64)

    def under(self) -> np.ndarray:
        """Underfull bins, the emptiest first."""
        found = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
        return found[np.argsort(self.fill[found], kind="stable")]

    def _span(self, b: int) -> tuple[int, int]:
        lo, hi = np.searchsorted(self.key, [b * self.base, (b + 1) * self.base])
        return int(lo), int(hi)

    def change(self, giver: int):
        """(place of the document given, taker, places given back) with the largest gain, or None; cheaper kinds first."""
        takers = (self.fill > 0) & (self.fill < self.capacity)
        if self.changed[giver] <= self.tried[giver]:  # what it could do with the others is known: nothing
            takers &= self.changed > self.tried[giver]
        takers[giver] = False
        taker = np.flatnonzero(takers)
        if not len(taker):
            return None
        lo, hi = self._span(giver)
        size, at = np.unique(self.key[lo:hi] - giver * self.base, return_index=True)
        give, level = size[:, None], self.fill[taker][None, :]
        room = self.capacity - level

        def best(less: np.ndarray, ok: np.ndarray, of: np.ndarray | None = None):
            """Place of the largest gain when ``less`` tokens come back."""
            free, high = (room, level) if of is None else (room[:, of], level[:, of])
            d = give - less
            gain = np.where(ok & (d > 0) & (d <= free), d * (high - self.fill[giver] + d), 0)
            k = int(np.argmax(gain))
            return divmod(k, gain.shape[1]) if gain.flat[k] > 0 else None

        if found := best(np.zeros_like(level), np.True_):
            return lo + int(at[found[0]]), int(taker[found[1]]), []
        key = np.append(self.key, len(self.fill) * self.base)
        # One for one: the gain grows with what the taker gains, so of each bin the shortest that leaves no overflow.
        first = np.searchsorted(key, taker * self.base + np.maximum(give - room, 0))
        back = key[first] - taker * self.base
        if found := best(back, back < self.base):
            return lo + int(at[found[0]]), int(taker[found[1]]), [int(first[found])]
        # Two for one: for each document of a taker, the shortest other that leaves no overflow.
        place = np.flatnonzero(takers[self.key // self.base])
        owner = self.key[place] // self.base
        of = np.searchsorted(taker, owner)
        one = self.key[place] - owner * self.base
        picked = None
        for g in range(len(size)):  # one document given at a time bounds the memory
            give = size[g:g + 1, None]
            other = np.searchsorted(key, owner * self.base + np.maximum(give[0] - room[0, of] - one, 0))
            other += other == place
            two = key[other] - owner * self.base
            if found := best((one + two)[None, :], (two < self.base)[None, :], of):
                d = int(size[g] - one[found[1]] - two[found[1]])
                gain = d * (int(self.fill[owner[found[1]]]) - int(self.fill[giver]) + d)
                if picked is None or gain > picked[0]:
                    picked = gain, (lo + int(at[g]), int(owner[found[1]]), [int(place[found[1]]), int(other[found[1]])])
        return picked and picked[1]

    def apply(self, giver: int, out: int, taker: int, back: list[int]) -> None:
        places = [out, *back]
        docs = self.docs[places]
        to = np.array([taker] + [giver] * len(back))
        moved = to * self.base + self.key[places] % self.base
        gain = int(self.key[out] % self.base - (self.key[back] % self.base).sum())
        self.fill[giver] -= gain
        self.fill[taker] += gain
        key, left = np.delete(self.key, places), np.delete(self.docs, places)
        order = np.argsort(moved, kind="stable")
        at = np.searchsorted(key, moved[order])
        self.key, self.docs = np.insert(key, at, moved[order]), np.insert(left, at, docs[order])
        self.clock += 1
        self.changed[[giver, taker]] = self.clock

    def lists(self) -> list[list[int]]:
        ends = np.searchsorted(self.key, np.arange(1, len(self.fill)) * self.base)
        return [b.tolist()[::-1] for b in np.split(self.docs, ends) if len(b)]


def improve(bins: list[list[int]], sizes: list[int], capacity: int, steps: int | None = None) -> list[list[int]]:
    """Local search between underfull bins, until the lower bound is met or no bin has a raising change left.

    A caller who wants a shorter search may give the number of ``steps`` at most.

    Bins give in turn, the emptiest first: a document moves, or is exchanged for
    one or two shorter ones of another bin.  The receiver gains ``d`` and must
    end fuller than the giver was, so the sum of squares rises by
    2 d (receiver - giver + d) and the search ends.  A bin that found nothing is
    compared again only with bins changed since.
    """
    steps = math.inf if steps is None else steps
    state = _Bins(bins, sizes, capacity)
    least = -(-int(state.fill.sum()) // capacity)
    alive, moving = int((state.fill > 0).sum()), True
    while moving and alive > least:
        moving = False
        for giver in state.under().tolist():
            while alive > least and steps > 0 and 0 < state.fill[giver] < capacity and (found := state.change(giver)):
                state.apply(giver, *found)
                steps -= 1
                alive -= int(state.fill[giver] == 0)
                moving = True
            state.tried[giver] = state.clock
    return state.lists()


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    return improve(best_fit(sizes, capacity), sizes, capacity)


# -- packing of a table ----------------------------------------------------

def _packed(rest: DataFrame, groups: int, level: int, capacity: int) -> DataFrame:
    """(uid, length, sequence_id, offset, fill) of the pieces, each group by itself."""
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "uid"], ascending=[False, True])
        uid, size = group["uid"].to_numpy(), group["length"].tolist()
        number = (level << 56) + (int(group["g"].iloc[0]) << 24)
        rows = []
        for b, members in enumerate(pack_sizes(size, capacity)):
            at, fill = 0, sum(size[i] for i in members)
            for i in members:
                rows.append((uid[i], size[i], number + b, at, fill))
                at += size[i]
        return pd.DataFrame(rows, columns=["uid", "length", "sequence_id", "offset", "fill"])

    return (rest.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(groups)).alias("g"))
            .groupBy("g").applyInPandas(pack, "uid long, length long, sequence_id long, offset long, fill long"))


def pack(pieces_: DataFrame, capacity: int = CAPACITY, group: int = GROUP, full: float = FULL) -> DataFrame:
    """``pieces_`` with ``sequence_id`` and ``offset``; every sequence is gapless from 0 and holds at most ``capacity``.

    Pieces as long as a sequence have one of their own.  An empty table gives an
    empty one; a piece longer than ``capacity`` is an error.  Columns named
    sequence_id or offset are replaced.
    """
    found = written(pieces_.drop("sequence_id", "offset").withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    if found.where(F.col("length") > capacity).limit(1).count():
        raise ValueError(f"a piece is longer than {capacity}")
    short = found.where(F.col("length") < capacity).select(F.col("_uid").alias("uid"), "length")
    count, kept, level = short.count(), [], 1
    groups = -(-count // group)
    done = written(_packed(short, groups, level, capacity), "packed") if count else None
    while done is not None:
        under = F.col("fill") < F.lit(full * capacity)
        rest = done.where(under)
        # Each sequence has one piece at its start.
        count, bins, tokens = rest.agg(F.count("*"), F.count(F.when(F.col("offset") == 0, 1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        if groups == 1 or bins <= -(-tokens // capacity):  # dealing anew would change nothing
            kept.append(done)
            break
        groups, level = min(groups, -(-count // group)), level + 1
        again = written(_packed(rest, groups, level, capacity), "packed")
        fewer = again.where("offset = 0").count()
        if fewer >= bins:
            kept.append(done)
            break
        kept.append(done.where(~under))
        if groups > 1 and (bins - fewer) <= SAVED * bins:
            kept.append(again)
            break
        done = again
    alone = (found.where(F.col("length") == capacity)
             .select(F.col("_uid").alias("uid"), (-F.col("_uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    places = alone
    for k in kept:
        places = places.unionByName(k.select("uid", "sequence_id", "offset"))
    return found.join(places, F.col("_uid") == F.col("uid")).drop("_uid", "uid")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, path, capacity, text, row_id), capacity)
