"""Personal data by weak supervision.

Four base kinds have exact patterns and checks and are always reported.  Beside
them, looser candidates (keys, long numbers) are put to labelers that vote
personal, not personal or abstain:

* regex: the candidate is a base span, or has the exact shape of a known key;
* gazetteer: the words before it belong to a list that announces such data, or
  to one that announces harmless numbers;
* context: the characters around it (assignment, quotes, prose);
* shape: how letters and digits alternate.

Expectation-maximisation (two classes, each labeler with its own confusion
table) estimates the labelers' reliabilities from how often each pattern of
votes occurs in the whole corpus, and gives each pattern a probability.  With
these as soft labels a logistic regression over votes and span statistics is the
final classifier.  Both see one row per distinct pattern with its count, a table
of bounded size, however large the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds in order, and the patterns of all but email.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "number")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Candidates: long runs of letters and digits with both; numbers of seven digits or more.
SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*[0-9])(?=[0-9_/+-]*[A-Za-z])[A-Za-z0-9][A-Za-z0-9_/+-]{10,}")
NUMBER = re.compile(r"\+?[0-9][0-9\x20().-]{5,}[0-9]")
KEY = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|(?:gh[pousr]|xox[abps]|sk|pk)[_-][A-Za-z0-9_-]{16,}|[0-9a-f]{32,}|[0-9A-F]{32,}")

#: Words before a span that announce personal data, and such as announce harmless numbers.
ANNOUNCE = frozenset("""account accesskey apikey bank bic card carte cell clave cle contact contraseña cuenta email fax handy iban id
    karte key kennwort konto mail mobile mot numero passport passwort password passwd pass phone pin pwd schlüssel secret ssn tarjeta
    tel telefon telefono telephone token""".split())
HARMLESS = frozenset("chapter chapitre isbn issn article page seite version volume figure table year jahr año".split())
_WORDS = re.compile(r"[^\W\d_]+")

LABELERS = 4
_SIZES = (14, 18, 24, 40)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails; each @ is looked at once, so that long runs stay linear."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, sorted."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = re.sub(r"[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _votes(text: str, a: int, b: int, kind: int) -> list[int]:
    """A vote of each labeler: 0 not personal, 1 abstains, 2 personal."""
    span, before = text[a:b], text[max(0, a - 24):a]
    regex = 2 if kind < len(BASE) or KEY.fullmatch(span) else 1
    words = {w.lower() for w in _WORDS.findall(before)[-2:]}
    gazetteer = 2 if words & ANNOUNCE else 0 if words & HARMLESS else 1
    last = before.rstrip(" ")[-1:]
    context = 2 if last in ("=", ":", '"', "'", "+", "#") or kind < len(BASE) else 0
    turns = sum(x.isdigit() != y.isdigit() for x, y in zip(span, span[1:]))
    shape = 2 if turns >= 4 else 0 if kind == 4 else 1
    return [regex, gazetteer, context, shape]


def _pattern(text: str, a: int, b: int, kind: int) -> int:
    """Votes, kind, length class and share of digits as one number; all that the model sees of a span."""
    digits = sum(c.isdigit() for c in text[a:b])
    code = kind * 5 + sum(b - a >= n for n in _SIZES)
    code = code * 5 + min(4, 5 * digits // (b - a))
    for v in _votes(text, a, b, kind):
        code = code * 3 + v
    return code


def _unpack(code: int) -> tuple[list[int], int, int, int]:
    votes = []
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        votes.insert(0, v)
    code, digits = divmod(code, 5)
    kind, size = divmod(code, 5)
    return votes, kind, size, digits


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of looser candidates that touch no base span and not each other; keys before numbers."""
    taken, out = bytearray(len(text)), []
    for a, _, b in base:
        taken[a:b] = b"\1" * (b - a)
    for kind, pattern in ((4, SECRET), (5, NUMBER)):
        for m in pattern.finditer(text):
            if taken.find(1, m.start(), m.end()) < 0:
                out.append((m.start(), kind, m.end()))
                taken[m.start():m.end()] = b"\1" * (m.end() - m.start())
    return sorted(out)


def _row(code: int) -> np.ndarray:
    votes, kind, size, digits = _unpack(code)
    x = np.zeros(1 + 3 * LABELERS + len(KINDS) + 10)
    x[0] = 1
    for j, v in enumerate(votes):
        x[1 + 3 * j + v] = 1
    x[1 + 3 * LABELERS + kind] = 1
    x[1 + 3 * LABELERS + len(KINDS) + size] = 1
    x[1 + 3 * LABELERS + len(KINDS) + 5 + digits] = 1
    return x


@dataclass(frozen=True)
class Model:
    """Weights of the final classifier, and the labelers' reliabilities P(vote | class)."""

    weights: tuple[float, ...] | None
    reliability: tuple | None

    def accepts(self, code: int) -> bool:
        return self.weights is not None and float(np.dot(self.weights, _row(code))) > 0


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """P(personal) of each vote pattern, and P(vote | class) as (class, labeler, vote)."""
    personal = 1 / (1 + np.exp(-2.0 * (votes - 1).sum(axis=1)))
    table = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        for y, p in ((0, 1 - personal), (1, personal)):
            for v in range(3):
                table[y, :, v] = ((votes == v) * (p * counts)[:, None]).sum(axis=0) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        prior = np.clip((personal * counts).sum() / counts.sum(), 0.01, 0.99)
        log = np.log([1 - prior, prior])[:, None] + np.stack([
            sum(np.log(table[y, j, votes[:, j]]) for j in range(votes.shape[1])) for y in (0, 1)])
        personal = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return personal, table


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression on soft labels ``y`` by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)),
                               x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _looked_at(text: Column) -> Column:
    """Texts without a digit or @ hold no span; they aren't sent to Python."""
    return F.when(text.rlike("[0-9@]"), text)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Learn from every candidate and base span of all texts, through counts per distinct pattern."""
    @F.pandas_udf("array<int>")
    def patterns(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for value in batch:
                if not value:
                    out.append([])
                    continue
                base = base_spans(value)
                out.append([_pattern(value, a, b, k) for a, k, b in base + candidates(value, base)])
            yield pd.Series(out)

    found = (docs.select(_looked_at(F.col(text)).alias("t")).where("t is not null")
             .select(F.explode(patterns("t")).alias("code")).groupBy("code").count().collect())
    if not found:
        return Model(None, None)
    found.sort()
    counts = np.array([r["count"] for r in found], float)
    votes = np.array([_unpack(r["code"])[0] for r in found])
    personal, table = expectation_maximisation(votes, counts)
    rows = np.stack([_row(r["code"]) for r in found])
    # The weight of a pattern grows with the root of its count, so that common ones don't drown the rest.
    return Model(tuple(logistic(rows, personal, np.sqrt(counts)).tolist()), tuple(map(tuple, table.reshape(2, -1).tolist())))


def spans(text: Column, model: Model) -> Column:
    """struct<base, added>: arrays of (kind, start, stop), code points, end exclusive, sorted by start, then kind.

    A null or empty text has none.  Added spans never touch a base span.
    """
    item = "array<struct<kind:string,start:int,stop:int>>"

    @F.pandas_udf(f"base {item}, added {item}")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch:
                base = base_spans(value) if value else []
                added = [s for s in candidates(value, base) if model.accepts(_pattern(value, s[0], s[2], s[1]))] if value else []
                rows.append(tuple([{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in x] for x in (base, added)))
            yield pd.DataFrame(rows, columns=["base", "added"])

    return found(_looked_at(text))


def detect(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``added`` (replacing columns of those names).  No shuffle."""
    out = docs.withColumn("_spans", spans(F.col(text), model))
    return out.withColumn("base", F.col("_spans.base")).withColumn("added", F.col("_spans.added")).drop("_spans")


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; overlapping spans are replaced as one."""
    @F.pandas_udf("string")
    def redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for value in batch:
                base = base_spans(value) if value else []
                every = sorted(base + [s for s in candidates(value, base) if model.accepts(_pattern(value, s[0], s[2], s[1]))] if value else [])
                parts, at = [], 0
                for a, k, b in every:
                    if a >= at:
                        parts += [value[at:a], f"[{KINDS[k].upper()}]"]
                    at = max(at, b)
                out.append("".join([*parts, value[at:]]) if every else value)
            yield pd.Series(out)

    return docs.withColumn(text, F.coalesce(redacted(_looked_at(F.col(text))), F.col(text)))
