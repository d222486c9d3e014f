"""Argument parsing and session set-up shared by the jobs."""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from meterwise.session import SESSION_DEFAULTS, ensure_checkpoint_dir  # noqa: E402


def parse(description: str, extra=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(description=description)
    ap.add_argument("--sf-dir", required=True, help="folder of the input parquet tables")
    ap.add_argument("--out", required=True, help="shared output root (tables, models)")
    ap.add_argument("--weekly", default=None, help="weekly input written by jobs/prepare.py (else derived)")
    for args, kwargs in (extra or []):
        ap.add_argument(*args, **kwargs)
    return ap.parse_args()


def session(app: str) -> SparkSession:
    """The cluster's session (spark-submit supplies master and sizes)."""
    builder = SparkSession.builder.appName(app)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def weekly(spark: SparkSession, args: argparse.Namespace, region: str | None = None):
    """The weekly input: the prepared table when given (region pruned), else derived."""
    from meterwise.sources.weekly import load_weekly, weekly_input
    if args.weekly:
        return load_weekly(spark, args.weekly, region)
    return weekly_input(spark, args.sf_dir, region=region)
