"""Token counts of whole texts under a byte-level BPE vocabulary, by rank-synchronous array merging.

Pre-tokens of a batch lie end to end in one numpy array of symbols (ragged:
a second array says which pre-token each symbol belongs to).  A round looks up
the rank of every neighbouring pair, takes the lowest rank of each pre-token,
and merges all places of that pair in all pre-tokens at once.  Pre-tokens
without a mergeable pair leave with the number of symbols they have left.
A pair made by a merge always has a higher rank than the merge that made it, so
this gives what merging one pair at a time gives.

A pre-token of more than LONG symbols would need a round over all its symbols for
every merge it has in turn.  Such pre-tokens are swept by rank instead: places
wait under the rank of their pair, all places of the lowest rank merge at once,
and only the pairs beside them are looked up anew.  The sweep has at most as many
rounds as the vocabulary has ranks, however long the pre-token.

Counts of pre-tokens are kept in a bounded table per Python worker; only those
not in it are merged.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import mixed

#: Pre-tokens remembered per Python worker; the table starts anew when it is full.
REMEMBERED = 500_000
#: Texts counted together.
CHUNK = 256
#: Bytes merged together; bounds the arrays of a round (a pre-token of more than LONG symbols is merged alone).
MERGED_BYTES = 1 << 20
#: Pre-tokens of more symbols are swept by rank.
LONG = 512
_NONE = np.int32(2**31 - 1)
#: Fixed value: how byte-level vocabularies cut a text into pre-tokens before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [chr(moved.get(b, b)) for b in range(256)]


class PairMerger:
    """Ranked merges of a BPE model (of the tokenizers library's ``.json``) as arrays."""

    def __init__(self, model: dict) -> None:
        ids = model["vocab"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("not a plain BPE model")
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = max(ids.values()) + 1
        self._index(np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64),
                    np.array([ids[a + b] for a, b in pairs], np.int64))

    def _index(self, keys: np.ndarray, made: np.ndarray) -> None:
        """Pairs by open addressing: slot -> key, rank, symbol made."""
        self.bits = max(19, len(keys).bit_length() + 2)
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_rank = np.full(1 << self.bits, _NONE, np.int32)
        self.slot_made = np.zeros(1 << self.bits, np.int64)
        self.probes = 1
        slots = self._slot(keys)
        for i, s in enumerate(slots.tolist()):
            n = 1
            while self.slot_key[s] >= 0:
                s = (s + 1) & ((1 << self.bits) - 1)
                n += 1
            self.slot_key[s], self.slot_rank[s], self.slot_made[s] = keys[i], i, made[i]
            self.probes = max(self.probes, n)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _found(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each pair, or -1."""
        slot = self._slot(keys)
        out = np.where(self.slot_key[slot] == keys, slot, -1)
        open_ = np.flatnonzero((out < 0) & (self.slot_key[slot] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at = slot[open_]
            hit = self.slot_key[at] == keys[open_]
            out[open_[hit]] = at[hit]
            open_ = open_[~hit & (self.slot_key[at] >= 0)]
        return out

    def merge(self, sym: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that are left and the pre-token of each, given those of all pre-tokens end to end."""
        out: list[tuple[np.ndarray, np.ndarray]] = [(sym[:0], seq[:0])]
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            size = np.diff(np.concatenate([first, [len(seq)]]))
            slot = np.full(len(sym), -1, np.int64)
            inner = np.flatnonzero(seq[1:] == seq[:-1])
            slot[inner] = self._found(sym[inner] * self.size + sym[inner + 1])
            rank = np.where(slot >= 0, self.slot_rank[slot], _NONE)
            best = np.minimum.reduceat(rank, first)
            best = np.repeat(best, size)
            done = best == _NONE
            out.append((sym[done], seq[done]))
            chosen = (rank == best) & (rank != _NONE)
            # Of overlapping places (aaa) every other one, from the left.
            begins = chosen & ~np.concatenate([[False], chosen[:-1]])
            run = np.maximum.accumulate(np.where(begins, np.arange(len(sym)), 0))
            chosen &= (np.arange(len(sym)) - run) % 2 == 0
            sym = np.where(chosen, self.slot_made[slot], sym)
            keep = ~np.concatenate([[False], chosen[:-1]]) & ~done
            sym, seq = sym[keep], seq[keep]
        sym, seq = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(seq, kind="stable")
        return sym[order], seq[order]


    def swept(self, sym: np.ndarray) -> np.ndarray:
        """The symbols left of one pre-token: as ``merge``, with places waiting under the rank of their pair."""
        n = len(sym)
        sym, after, before = sym.copy(), np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.full(n, _NONE, np.int32)  # of the pair that begins at a place; _NONE also where no symbol is left
        made = np.zeros(n, np.int64)
        live = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(places: np.ndarray) -> None:
            """Look up the pairs that begin at ``places`` and put them under their ranks."""
            slot = self._found(sym[places] * self.size + sym[after[places]])
            rank[places] = np.where(slot >= 0, self.slot_rank[slot], _NONE)
            made[places] = self.slot_made[slot]
            places = places[slot >= 0]
            order = np.argsort(rank[places], kind="stable")
            places = places[order]
            edges = np.flatnonzero(np.diff(rank[places])) + 1
            for group in np.split(places, edges) if len(places) else ():
                r = int(rank[group[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(group)

        wait(np.arange(n - 1))
        while ranks:
            lowest = heapq.heappop(ranks)
            places = np.unique(np.concatenate(waiting.pop(lowest)))
            places = places[rank[places] == lowest]  # others have changed since they began to wait
            if not len(places):
                continue
            # Of overlapping places (aaa) every other one, from the left.
            begins = np.concatenate([[True], after[places[:-1]] != places[1:]])
            run = np.maximum.accumulate(np.where(begins, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run) % 2 == 0]
            gone = after[places]
            sym[places] = made[places]
            live[gone], rank[gone], rank[places] = False, _NONE, _NONE
            after[places] = after[gone]
            inner = after[places] < n
            before[after[places[inner]]] = places[inner]
            left = before[places]
            wait(np.unique(np.concatenate([left[left >= 0], places[inner]])))
        return sym[live]


class Vocabulary(PairMerger):
    """A byte-level BPE file and the counts remembered so far."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        super().__init__(spec["model"])
        self.symbol = np.array([spec["model"]["vocab"][c] for c in byte_letters()], np.int64)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.tokens: dict[str, int] = {}

    def merged(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each (non-empty) pre-token."""
        if len(pieces) == 1 and len(pieces[0]) > LONG:
            return np.array([len(self.swept(self.symbol[np.frombuffer(pieces[0], np.uint8)]))])
        sym = self.symbol[np.frombuffer(b"".join(pieces), np.uint8)]
        seq = np.repeat(np.arange(len(pieces)), np.fromiter(map(len, pieces), np.int64, len(pieces)))
        return np.bincount(self.merge(sym, seq)[1], minlength=len(pieces))

    def _learn(self, tokens: set[str]) -> None:
        """Remember the counts of new pre-tokens."""
        new = list(tokens)
        raw = [t.encode("utf-8", "surrogatepass") for t in new]
        at = 0
        while at < len(raw):
            end, size = at, 0
            while end < len(raw) and (end == at or len(raw[at]) <= LONG >= len(raw[end]) and size + len(raw[end]) <= MERGED_BYTES):
                size += len(raw[end])
                end += 1
            self.tokens.update(zip(new[at:end], self.merged(raw[at:end]).tolist()))
            at = end

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a special token's string counts as that one token."""
        if len(self.tokens) > REMEMBERED:
            self.tokens = {}
        segments: list[tuple[int, str]] = []
        total = [0] * len(texts)
        for i, text in enumerate(texts):
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                total[i] = len(parts) - 1
                segments += [(i, p) for p in parts if p]
            elif text:
                segments.append((i, text))
        pieces = [_PRE.findall(text) for _, text in segments]
        self._learn(set().union(*pieces) - self.tokens.keys())
        of = self.tokens.__getitem__
        for (i, _), p in zip(segments, pieces):
            total[i] += sum(map(of, p))
        return total


_PRE = regex.compile(PATTERN)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Read once per Python worker, from a path that every executor has."""
    return Vocabulary(path)


def token_count(text: Column, path: str) -> Column:
    """Number of tokens (long) of a text; null and empty texts have 0."""
    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = [t or "" for t in batch.tolist()]
            out = [n for i in range(0, len(texts), CHUNK) for n in vocab.counts(texts[i:i + CHUNK])]
            yield pd.Series(out, dtype="int64")

    return counted(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (replacing columns of those names).

    Any null, empty, repeated or very long text is counted whole; a null text
    counts as empty.  No shuffle.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    return (docs.withColumns({"n_bytes": F.octet_length(content).cast("long"), "n_tokens": token_count(content, path)})
            .withColumn("over_limit", F.col("n_tokens") > limit))
