"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from meterwise.plans import registry
from tests.conftest import SF_SMALL
from tests.helpers import duck_rows, spark_rows

ORACLES = E.oracle_sql()
# Spark type -> DuckDB type of the same values.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(duck(SF_SMALL), ORACLES[name])
    assert s_cols == d_cols
    rel = duck(SF_SMALL).sql(ORACLES[name])
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == dict(zip(rel.columns, map(str, rel.types)))
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_registry_contract():
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    # Everything in the catalog except the boosted-tree figures has an oracle.
    assert set(registry()) <= set(qs) and set(registry()) - set(ors) == {"gbt_scores", "forecast_boosted"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["workload_type", "model_path", "query_count", "total_execution_hours", "total_credits",
                          "avg_credits_per_query", "estimated_cost_dollars"]
    assert df.count() >= 0
