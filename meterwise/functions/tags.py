"""Query-tag classification and parsing (native Column expressions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterwise import params as P


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify(tag, prefix: str, classes: Sequence[str], default: str | None) -> Column:
    """First class whose ``<prefix>:<class>`` occurs in the tag, else ``default``.

    A NULL tag matches nothing and falls through to the default, exactly like a
    ``CASE WHEN tag LIKE '%...%'`` chain.
    """
    tag = _col(tag)
    out = None
    for cls in classes:
        cond = tag.contains(f"{prefix}{P.TAG_KV_SEP}{cls}")
        out = F.when(cond, F.lit(cls)) if out is None else out.when(cond, F.lit(cls))
    return out.otherwise(F.lit(default).cast("string"))


def workload_type(tag="query_tag", classes: Sequence[str] = P.WORKLOAD_CLASSES,
                  default: str | None = P.WORKLOAD_DEFAULT) -> Column:
    return classify(tag, "WORKLOAD", classes, default)


def model_path(tag="query_tag", classes: Sequence[str] = P.PATH_CLASSES,
               default: str | None = P.PATH_DEFAULT) -> Column:
    return classify(tag, "PATH", classes, default)


def tag_field(tag, key: str) -> Column:
    """Value of ``key`` in a ``K:V|K:V`` tag, NULL when absent."""
    pattern = rf"(?:^|\|){key}:([^|]*)"
    value = F.regexp_extract(_col(tag), pattern, 1)
    return F.when(value == "", F.lit(None).cast("string")).otherwise(value)


def parse_tag(tag="query_tag") -> list[Column]:
    """Split a full tag into workload, path and the scheduled flag."""
    return [
        tag_field(tag, "WORKLOAD").alias("tag_workload"),
        tag_field(tag, "PATH").alias("tag_path"),
        F.coalesce(F.upper(tag_field(tag, "SCHEDULED")) == "TRUE", F.lit(False)).alias("is_scheduled"),
    ]


def text_like(text, pattern: str) -> Column:
    """Case-insensitive LIKE."""
    return _col(text).ilike(pattern)
