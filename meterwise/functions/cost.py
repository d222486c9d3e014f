"""Cost estimator: a Column expression and the same as a SQL function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def estimate_cost(runtime_hours, credits_per_hour, dollars_per_credit) -> Column:
    """credits = hours x rate; dollars = credits x price, as one struct.

    Any NULL input (for example a parameter that was never seeded) gives NULL
    members, as the SQL estimator does.
    """
    h = F.col(runtime_hours) if isinstance(runtime_hours, str) else runtime_hours
    r = F.col(credits_per_hour) if isinstance(credits_per_hour, str) else credits_per_hour
    d = F.col(dollars_per_credit) if isinstance(dollars_per_credit, str) else dollars_per_credit
    return F.struct((h * r).alias("estimated_credits"), (h * r * d).alias("estimated_dollars"))


def register_sql_estimator(spark, name: str = "estimate_wh_cost") -> None:
    """The estimator as a SQL function, callable with named arguments."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            runtime_hours DOUBLE, credits_per_hour DOUBLE, dollars_per_credit DOUBLE)
        RETURNS STRUCT<estimated_credits: DOUBLE, estimated_dollars: DOUBLE>
        RETURN named_struct(
            'estimated_credits', runtime_hours * credits_per_hour,
            'estimated_dollars', runtime_hours * credits_per_hour * dollars_per_credit)
    """)
