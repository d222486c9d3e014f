"""Quality scores by regularised quadratic discriminant analysis.

A document is a vector of transformed statistics of its whole text.  Each class
has a mean and a covariance shrunk towards the pooled one and a multiple of the
identity.  The score is the probability of the good class from the difference of
the two Gaussian log densities, whose Mahalanobis distances come from Cholesky
factors computed and inverted once.

The moments of the classes are sums that Spark aggregates over all training
rows; only they (two numbers per pair of features and class) reach the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weight of the pooled covariance in a class's, and of the mean variance on the diagonal.
POOLED, RIDGE = 0.1, 0.02
#: Probabilities are kept off 0 and 1 by this much.
EDGE = 1e-9

FEATURES = ("log_chars", "word_length", "letters", "capitals", "digits", "spaces", "marks", "other_signs", "distinct_words",
            "top_word", "echoed_words", "unworded", "lines", "repeated_lines")


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a text; shares are variance-stabilised (arc sine of the square root)."""
    text = text or ""
    n = len(text)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    upper = int(raw[65:91].sum())
    # Leading bytes stand for letters outside ASCII; signs outside ASCII are rare enough not to matter.
    letters = upper + int(raw[97:123].sum()) + int(raw[194:].sum())
    digits, spaces = int(raw[48:58].sum()), int(raw[[9, 10, 13, 32]].sum())
    marks = int(raw[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum())
    other = int(raw[33:127].sum()) - int(raw[48:58].sum() + raw[65:91].sum() + raw[97:123].sum()) - marks
    words = text.split()
    counts = Counter(words)
    lines = text.split("\n")

    def share(a: float, b: float) -> float:
        return math.asin(math.sqrt(min(1.0, a / b))) if b else 0.0

    echoed = sum(a == b for a, b in zip(words, words[1:]))
    unworded = sum(not w[-1].isalnum() and not w[-1] in ".,;:?" for w in words)
    return [math.log1p(n), math.log1p((n - spaces) / len(words)) if words else 0.0, share(letters, n), share(upper, letters),
            share(digits, n), share(spaces, n), share(marks, n), share(other, n), share(len(counts), len(words)),
            share(max(counts.values(), default=0), len(words)), share(echoed, len(words) - 1), share(unworded, len(words)),
            math.log1p(len(lines)), share(len(lines) - len(set(lines)), len(lines))]


def features(text: Column) -> Column:
    """array<double> of FEATURES; a null text counts as empty."""
    @F.pandas_udf("array<double>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([statistics(t) for t in batch])

    return found(text)


@dataclass(frozen=True)
class Model:
    """Scaling of the features and, per class, mean, inverse of the Cholesky factor, log determinant and log prior."""

    centre: np.ndarray
    scale: np.ndarray
    classes: tuple[tuple[np.ndarray, np.ndarray, float, float] | None, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 per row; a class never seen has probability 0, and both have a half if neither was."""
        if self.classes == (None, None):
            return np.full(len(x), 0.5)
        if None in self.classes:
            return np.full(len(x), 1 - EDGE if self.classes[0] is None else EDGE)
        z = (x - self.centre) / self.scale
        density = []
        for mean, inverse, log_det, prior in self.classes:
            # |L^-1 (z - mean)|^2 is the Mahalanobis distance for covariance L L^T.
            distance = np.sum(((z - mean) @ inverse.T) ** 2, axis=1)
            density.append(prior - 0.5 * (distance + log_det))
        return np.clip(1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700))), EDGE, 1 - EDGE)


def fit(rows: DataFrame, x: str = "features", label: str = "label", pooled: float = POOLED, ridge: float = RIDGE) -> Model:
    """Fit on all rows with a label of 0 or 1; one aggregation, two rows to the driver.

    Without such a row the model knows neither class.
    """
    d = len(FEATURES)
    col = [F.col(x)[i] for i in range(d)]
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(col)]
    sums += [F.sum(col[i] * col[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    found = {r["y"]: r for r in rows.where(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("y"))
             .agg(F.count("*").alias("n"), *sums).collect()}
    if not found:
        return Model(np.zeros(d), np.ones(d), (None, None))
    total = sum(r["n"] for r in found.values())
    moment = {}
    for y, r in found.items():
        product = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                product[i, j] = product[j, i] = r[f"p{i}_{j}"]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        moment[y] = (r["n"], mean, product / r["n"] - np.outer(mean, mean))
    centre = sum(n * m for n, m, _ in moment.values()) / total
    within = sum(n * c for n, _, c in moment.values()) / total
    spread = np.diag(within) + sum(n * (m - centre) ** 2 for n, m, _ in moment.values()) / total
    scale = np.where(spread > 1e-12, np.sqrt(np.maximum(spread, 1e-12)), 1.0)
    unit = np.outer(scale, scale)
    classes = []
    for y in (0, 1):
        if y not in moment:
            classes.append(None)
            continue
        n, mean, own = moment[y]
        cov = (1 - pooled) * own / unit + pooled * within / unit
        cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        classes.append(((mean - centre) / scale, np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()), math.log(n / total)))
    return Model(centre, scale, tuple(classes))


def score(x: Column, model: Model) -> Column:
    """Probability (0 to 1) that a row of FEATURES is of the good class."""
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.score(np.stack(batch.to_numpy())) if len(batch) else [], dtype="float64")

    return scored(x)


def classify(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", row_id: str = "doc_id",
             label: str = "quality") -> DataFrame:
    """(doc_id, features, score) of every row, learnt from the rows where ``learn`` holds and a label exists.

    ``learn`` may use the id column only.  Null and empty texts have the
    statistics of an empty text and a score like any other; labels that are null
    or neither 0 nor 1, or without a document, are not used, and a row repeated
    on either side counts as often as it occurs.  If no usable label is left every
    score is 0.5; if one class has none, the other's rows decide (score near 0 or 1).
    Empty ``docs`` give no rows.  The statistics are computed once and written;
    texts aren't shuffled.
    """
    from meterwise.llm.common import written

    stats = written(docs.select(F.col(row_id), features(F.col(text)).alias("features")), "statistics")
    marks = labels.select(F.col(row_id).alias("_id"), F.col(label).alias("label")).where(F.col("label").isin(0, 1))
    known = stats.where(learn).join(marks, F.col(row_id) == F.col("_id"))
    return stats.withColumn("score", score(F.col("features"), fit(known)))
