"""Model and feature-view registries kept as versioned tables on shared storage.

A registry is a small metadata table (one row per version) next to the
artifacts it points at.  Artifacts are written first, then the table is merged
and swapped by one rename: a failed job leaves the registry as it was, and two
jobs that register at once cannot overwrite each other's entry.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.schemas import FEATURE_VIEWS, REGISTRY
from meterwise.sources.versions import VersionedTable


def _now_literal(stamp: dt.datetime | None):
    if stamp is None:
        return F.current_timestamp()
    return F.lit(stamp.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


class ModelRegistry:
    """F8: log, get and drop model versions (artifacts under ``root``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.table = VersionedTable(spark, f"{self.root}/_models", keys=["model_name", "version_name"])

    def entries(self) -> DataFrame:
        return self.table.create(REGISTRY)

    def log_model(self, model: PipelineModel, name: str, version: str, comment: str = "",
                  created_at: dt.datetime | None = None) -> str:
        artifact = f"{self.root}/{name}/{version}"
        model.write().overwrite().save(artifact)
        row = (self.spark.createDataFrame([(name, version, artifact, comment)],
                                          "model_name string, version_name string, artifact string, comment string")
               .withColumn("created_at", _now_literal(created_at)))
        self.entries()
        self.table.merge(row)
        return artifact

    def get(self, name: str, version: str) -> PipelineModel:
        rows = (self.entries().filter((F.col("model_name") == name) & (F.col("version_name") == version))
                .select("artifact").limit(1).collect())
        if not rows:
            raise KeyError(f"model {name}/{version} is not registered")
        return PipelineModel.load(rows[0]["artifact"])

    def drop(self, name: str) -> None:
        """DROP MODEL IF EXISTS: remove every version's row and artifact."""
        entries = self.entries()
        gone = entries.filter(F.col("model_name") == name).select("artifact").collect()
        self.table.replace(entries.filter(F.col("model_name") != name))
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for r in gone:
            p = jvm.org.apache.hadoop.fs.Path(r["artifact"])
            p.getFileSystem(conf).delete(p, True)


class FeatureViewRegistry:
    """register, read and delete versioned feature views (materialised as parquet)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.table = VersionedTable(spark, f"{self.root}/_feature_views", keys=["name", "version"])

    def entries(self) -> DataFrame:
        return self.table.create(FEATURE_VIEWS)

    def register_view(self, df: DataFrame, name: str, version: str, entity_keys, timestamp_col: str,
                      created_at: dt.datetime | None = None) -> DataFrame:
        path = f"{self.root}/{name}/{version}"
        keys = list(entity_keys)
        # Clustered by entity key and time, as the view is read by key and as-of time.
        df.repartitionByRange(*keys, timestamp_col).sortWithinPartitions(*keys, timestamp_col) \
            .write.mode("overwrite").parquet(path)
        row = (self.spark.createDataFrame([(name, version, path, ",".join(keys), timestamp_col)],
                                          "name string, version string, path string, entity_keys string, "
                                          "timestamp_col string")
               .withColumn("created_at", _now_literal(created_at)))
        self.entries()
        self.table.merge(row)
        return self.spark.read.parquet(path)

    def read_view(self, name: str, version: str) -> DataFrame:
        rows = (self.entries().filter((F.col("name") == name) & (F.col("version") == version))
                .select("path").limit(1).collect())
        if not rows:
            raise KeyError(f"feature view {name}/{version} is not registered")
        return self.spark.read.parquet(rows[0]["path"])

    def delete_view(self, name: str, version: str) -> bool:
        entries = self.entries()
        hit = (F.col("name") == name) & (F.col("version") == version)
        paths = entries.filter(hit).select("path").collect()
        if not paths:
            return False
        self.table.replace(entries.filter(~hit))
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for r in paths:
            p = jvm.org.apache.hadoop.fs.Path(r["path"])
            p.getFileSystem(conf).delete(p, True)
        return True
