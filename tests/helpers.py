"""Row comparison helpers shared by the tests."""

from __future__ import annotations

import decimal
import math


def norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, digits)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def sorted_rows(records, cols, digits=6):
    rows = [tuple(norm(r[c], digits) for c in cols) for r in records]
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def spark_rows(df, digits=6):
    cols = sorted(df.columns)
    return cols, sorted_rows([r.asDict() for r in df.collect()], cols, digits)


def duck_rows(con, sql, digits=6):
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    recs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    return cols, sorted_rows(recs, cols, digits)
