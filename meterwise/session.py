"""Spark session defaults and shared-storage helpers.

Every operator in the package is a plain ``DataFrame -> DataFrame`` function;
this module only holds the configuration they assume (UTC session time,
adaptive query execution) and the location of durable scratch storage.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  Shuffle partitions are left to the caller:
# a cluster sizes them to the data, tests use a handful.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "meterwise",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (not ``local-cluster``)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` (a startup setting) is honoured as Spark applies
    it; a private folder is set on the SparkContext only in local mode and when
    nothing is configured (tests).  On a cluster an unset folder is an error: a
    folder of one machine is not seen by the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="meterwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job output."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/meterwise/{name}-{uuid.uuid4().hex[:12]}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the lineage, and the planner knows its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def tagged(spark: SparkSession, workload: str, path: str | None = None, scheduled: bool = False):
    """Label every Spark job in the block with a ``WORKLOAD:x|PATH:y`` tag.

    The tag is set as a job tag and as the job description, so it shows in
    event logs and can be joined back to usage; it is always cleared.
    """
    tag = f"WORKLOAD:{workload}" + (f"|PATH:{path}" if path else "") + ("|SCHEDULED:TRUE" if scheduled else "")
    spark.addTag(tag)
    spark.sparkContext.setJobDescription(tag)
    try:
        yield tag
    finally:
        spark.removeTag(tag)
        spark.sparkContext.setJobDescription(None)
