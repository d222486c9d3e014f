"""Materialise the weekly input once (S6 + clustering), for the other jobs to read.

    spark-submit jobs/prepare.py --sf-dir <tables> --out <root>

Written partitioned by region and sorted by (isrc, week_ending) inside each
file, so a region filter prunes whole folders and the per-track windows of
the training and scoring jobs read their rows clustered.  The quality report
and the weekly summary (plays and distinct tracks per region and week) are
refreshed from the written table.
"""

from __future__ import annotations

from common import parse, session

from meterwise.operators.features import weekly_summary
from meterwise.operators.quality import quality_report
from meterwise.session import tagged
from meterwise.sources.weekly import load_weekly, store_weekly, weekly_input


def main() -> str:
    args = parse(__doc__)
    spark = session("meterwise-prepare")
    with tagged(spark, "DATA_PREP"):
        weekly = weekly_input(spark, args.sf_dir)
        prepared = load_weekly(spark, store_weekly(weekly, f"{args.out}/weekly_input"))
        quality_report(prepared).write.mode("overwrite").parquet(f"{args.out}/weekly_quality")
        # The weekly summary, kept as a table refreshed with its input (a materialised view).
        weekly_summary(prepared).write.mode("overwrite").partitionBy("region").parquet(f"{args.out}/weekly_summary")
    return "OK"


if __name__ == "__main__":
    print(main())
