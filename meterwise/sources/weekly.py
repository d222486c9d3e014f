"""Weekly play counts per region and track.

Tracks are part brands, plays are shipped quantities, regions are supplier
regions, and weeks run Sunday to Saturday (FIXTURES.md).  The regional rows
and the ``Global`` roll-up come out of ONE aggregation with grouping sets,
so lineitem is scanned and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.plans.sizing import bounded_broadcast
from meterwise.schemas import WEEKLY_INPUT, conform
from meterwise.sources.tables import read_table

GLOBAL = "Global"


def week_ending(ts) -> F.Column:
    """Saturday that closes the Sunday-to-Saturday week holding ``ts``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_add(F.date_trunc("week", c + F.expr("INTERVAL 1 DAY")).cast("date"), 5)


def track_columns(brand: F.Column) -> list[F.Column]:
    return [
        brand.alias("isrc"),
        F.concat(F.lit("Artist "), brand).alias("display_artist"),
        F.concat(F.lit("Track "), brand).alias("track"),
        F.date_add(F.lit("1995-01-01").cast("date"), -7 * F.substring(brand, 7, 10).cast("int")).alias("release_date"),
    ]


def shipments_of(spark: SparkSession, sf_dir: str):
    """A function mapping lineitem rows to (region, brand, week, quantity) rows.

    The dimension side (part, supplier -> region) is built once; the returned
    function applies it to any lineitem DataFrame, batch or streaming.
    """
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation (25 rows) and region (5 rows) have a fixed size: broadcasting them is bounded.
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supp_region = (supp.join(F.broadcast(nation), supp.s_nationkey == nation.n_nationkey)
                   .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
                   .select("s_suppkey", "r_name"))
    # Each supplier has one nation and one region, so supplier's row count
    # bounds supp_region: broadcast it when that count is small (a footer-only
    # count), else let the planner shuffle.  Catalyst alone over-estimates the
    # join (product of input sizes) and would shuffle lineitem needlessly.
    supp_region = bounded_broadcast(supp_region, supp)

    def apply(lineitem: DataFrame) -> DataFrame:
        li = lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
        # part grows with the data and is a single scan, whose size Catalyst
        # estimates well: no hint, Catalyst/AQE pick broadcast or sort-merge.
        return (li.join(part, li.l_partkey == part.p_partkey)
                .join(supp_region, li.l_suppkey == supp_region.s_suppkey)
                .select("r_name", "p_brand", week_ending("l_shipdate").alias("week_ending"), "l_quantity"))

    return apply


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments_of(spark, sf_dir)(read_table(spark, sf_dir, "lineitem"))


def weekly_input(spark: SparkSession, sf_dir: str, region: str | None = None) -> DataFrame:
    """All regional rows plus the Global roll-up, optionally one region only."""
    rows = _shipments(spark, sf_dir)
    if region is not None and region != GLOBAL:
        agg = (rows.filter(F.col("r_name") == region)
               .groupBy("r_name", "p_brand", "week_ending")
               .agg(F.sum("l_quantity").alias("q"))
               .select(F.col("r_name").alias("region"), "p_brand", "week_ending", "q"))
    elif region == GLOBAL:
        # Global = sum of the regional weekly totals; each regional total is cast
        # to bigint first, as in the two-level definition.
        regional = rows.groupBy("r_name", "p_brand", "week_ending").agg(F.round(F.sum("l_quantity")).cast("bigint").alias("q"))
        agg = (regional.groupBy("p_brand", "week_ending").agg(F.sum("q").alias("q"))
               .select(F.lit(GLOBAL).alias("region"), "p_brand", "week_ending", "q"))
    else:
        regional = rows.groupBy("r_name", "p_brand", "week_ending").agg(F.round(F.sum("l_quantity")).cast("bigint").alias("q"))
        agg = (regional.groupingSets([["r_name", "p_brand", "week_ending"], ["p_brand", "week_ending"]],
                                     "r_name", "p_brand", "week_ending")
               .agg(F.sum("q").alias("q"))
               .select(F.coalesce("r_name", F.lit(GLOBAL)).alias("region"), "p_brand", "week_ending", "q"))
    brand = F.col("p_brand")
    out = agg.select("region", *track_columns(brand), "week_ending", F.col("q").cast("bigint").alias("streams"))
    return conform(out, WEEKLY_INPUT)


def store_weekly(weekly: DataFrame, path: str) -> str:
    """The weekly table in a folder per region, rows clustered by track and week within files."""
    (weekly.repartition("region", "isrc").sortWithinPartitions("region", "isrc", "week_ending")
     .write.mode("overwrite").partitionBy("region").parquet(path))
    return path


def load_weekly(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """Scan a stored weekly table; a region filter, or a join with filtered regions, prunes its folders."""
    df = spark.read.parquet(path)
    return df if region is None else df.filter(F.col("region") == region)
