"""Shared Spark session and data locations for the test suite."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from meterwise.session import SESSION_DEFAULTS, ensure_checkpoint_dir

    builder = (SparkSession.builder.master("local[4]").appName("meterwise-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from meterwise.sources.tables import TABLES, table_path

    cons = {}

    def get(sf_dir: str):
        if sf_dir not in cons:
            con = duckdb.connect()
            for t in TABLES:
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
            cons[sf_dir] = con
        return cons[sf_dir]

    return get
