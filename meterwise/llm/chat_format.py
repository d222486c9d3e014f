"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole::

    <|im_start|>role<|im_sep|>text<|im_end|>\\n     (each turn)

and encoded once with offsets.  The three marks are special tokens, so no token
straddles the edge of a text.  The spans of the turns and of the tokens are both
sorted; the tokens of each assistant text are found by binary search, and these
make the loss mask.

Control strings inside texts and roles are escaped reversibly: ``<`` and ``|``
with any number of backslashes between them get one more, so that ``<|`` stands
for a mark alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Turns read before the finished conversations among them are encoded.
CHUNK = 2000

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)" + re.escape(SEP) + r"(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation, and the span of each text in it (code points)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def mask_of(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens that lie in one of the sorted spans."""
    mask = np.zeros(len(starts), bool)
    if len(spans) and len(starts):
        a, b = np.array(spans).T
        first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b, side="left")
        for i, j in zip(first[a < b], last[a < b]):
            mask[i:j] = True
    return mask


def masked_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The unescaped text of each run of tokens under the mask."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.asarray(mask).astype(np.int8), [0]])))
    return [unescape(formatted[starts[i]:ends[j - 1]]) for i, j in edge.reshape(-1, 2)]


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer with the three marks added; read once per Python worker."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.post_processor = None  # it could trim offsets
    tokenizer.add_special_tokens([START, SEP, END])
    return tokenizer


def sorted_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[list[pd.DataFrame]]:
    """Groups of consecutive rows with one key, from batches sorted by it; several groups at a time."""
    held: list[pd.DataFrame] = []

    def same(a: object, b: object) -> bool:
        return bool(a == b) or bool(pd.isna(a) and pd.isna(b))

    for batch in batches:
        if batch.empty:
            continue
        keys = batch[key]
        new = ((keys != keys.shift()) & ~(keys.isna() & keys.shift().isna())).to_numpy()
        new[0] = True
        first = np.flatnonzero(new)
        parts = [batch.iloc[i:j] for i, j in zip(first, [*first[1:], len(batch)])]
        if held and same(held[0][key].iloc[0], parts[0][key].iloc[0]):
            held.append(parts.pop(0))
        if parts:
            done = ([pd.concat(held)] if held else []) + parts[:-1]
            held = [parts[-1]]
            if done:
                yield done
    if held:
        yield [pd.concat(held)]


_FORMATTED = "formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>"


def format_conversations(turns: DataFrame, path: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, token_ids, token_starts, token_ends, loss_mask.

    Turns are ordered by turn, then role and text (so ties and repeated rows
    have one order); a null role or text is empty, a null turn is first, and rows
    without a conv_id are one conversation.  One shuffle by conversation, sorted
    there and read as a stream: a task holds one conversation at a time, which
    as one training example must fit.
    """
    kind = turns.schema[conv_id].dataType.simpleString()
    rows = (turns.select(F.col(conv_id).alias("_c"), F.col(turn).alias("_t"), F.coalesce(F.col(role), F.lit("")).alias("_r"),
                         F.coalesce(F.col(text), F.lit("")).alias("_x"))
            .repartition("_c").sortWithinPartitions("_c", "_t", "_r", "_x").select(F.col("_c").cast("string").alias("_c"), "_r", "_x"))

    def formatted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = encoder(path)
        smaller = (b.iloc[i:i + CHUNK] for b in batches for i in range(0, len(b), CHUNK))
        for groups in sorted_groups(smaller, "_c"):
            rendered = [render(list(zip(g["_r"], g["_x"]))) for g in groups]
            out = []
            for g, (whole, spans), found in zip(groups, rendered, tokenizer.encode_batch([w for w, _ in rendered], add_special_tokens=False)):
                place = np.array(found.offsets, np.int32).reshape(-1, 2)
                own = [s for s, r in zip(spans, g["_r"]) if r == trained_role]
                out.append((g["_c"].iloc[0], whole, found.ids, place[:, 0], place[:, 1], mask_of(place[:, 0], place[:, 1], own)))
            yield pd.DataFrame(out, columns=["_c", "formatted", "token_ids", "token_starts", "token_ends", "loss_mask"])

    return (rows.mapInPandas(formatted, f"_c string, {_FORMATTED}")
            .select(F.col("_c").cast(kind).alias(conv_id), "formatted", "token_ids", "token_starts", "token_ends", "loss_mask"))


def read_back(formatted: DataFrame, per_row: Callable[[str, np.ndarray, np.ndarray, np.ndarray], tuple], schema: str) -> DataFrame:
    """``per_row`` of each conversation's text, token starts, token ends and mask, as a struct column ``read``."""
    names = [c.split()[0] for c in schema.split(",")]

    @F.pandas_udf(schema)
    def read(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            yield pd.DataFrame([per_row(*row) for row in zip(*columns)], columns=names)

    return formatted.withColumn("read", read("formatted", "token_starts", "token_ends", "loss_mask"))
