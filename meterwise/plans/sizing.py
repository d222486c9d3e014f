"""Size-checked broadcasting.

A side is broadcast only when an upper bound on its rows is proven and
measured: ``bounded_broadcast(side, bound=table)`` counts ``table`` (a
parquet ``count()`` reads row-group footers, not data) and broadcasts
``side`` when the count is under ``max_rows``.  Above the cap the join is
left to the planner (sort-merge or shuffled hash join, with AQE skew
splitting), so nothing oversized is ever shipped to every executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows x ~32 bytes per (key, short string) row stays well under executor memory.
DEFAULT_MAX_ROWS = 1_000_000


def bounded_broadcast(side: DataFrame, bound: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``broadcast(side)`` if ``bound`` (which has at least as many rows) is small enough."""
    return F.broadcast(side) if bound.count() <= max_rows else side
