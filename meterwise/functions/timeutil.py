"""Time helpers: window bounds and boundary-counting differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterwise import params as P

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (folds to a constant, so it reaches the scan)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def window_start(as_of: dt.datetime = P.AS_OF, days: int | None = None) -> dt.datetime | None:
    return None if days is None else as_of - dt.timedelta(days=days)


def hour_floor(value: dt.datetime) -> dt.datetime:
    return value.replace(minute=0, second=0, microsecond=0)


def last_days(df, ts: str = "start_time", days: int | None = 7, as_of: dt.datetime = P.AS_OF):
    """Rows with ``ts >= as_of - days``; no bound when ``days`` is None."""
    if days is None:
        return df
    return df.filter(F.col(ts) >= ntz(window_start(as_of, days)))


def trunc(unit: str, ts) -> Column:
    """``date_trunc`` cast back to TIMESTAMP_NTZ (Spark returns a zoned timestamp)."""
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def diff_units(unit: str, start, end) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``.

    This is the warehouse DATEDIFF convention (00:59 -> 01:01 is one hour),
    not Spark's ``timestampdiff`` which counts whole elapsed units.
    """
    seconds = _UNIT_SECONDS[unit]
    a = F.unix_seconds(F.date_trunc(unit, _col(start)))
    b = F.unix_seconds(F.date_trunc(unit, _col(end)))
    return ((b - a) / F.lit(seconds)).cast("bigint")


def ms_to_seconds(ms) -> Column:
    return _col(ms) / F.lit(1000)
