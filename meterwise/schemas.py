"""Declared schemas of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

WEEKLY_INPUT = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("isrc", T.StringType()),
    T.StructField("display_artist", T.StringType()),
    T.StructField("track", T.StringType()),
    T.StructField("release_date", T.DateType()),
    T.StructField("week_ending", T.DateType()),
    T.StructField("streams", T.LongType()),
])

SCORED_OUTPUT = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("isrc", T.StringType()),
    T.StructField("display_artist", T.StringType()),
    T.StructField("track", T.StringType()),
    T.StructField("release_date", T.DateType()),
    T.StructField("week_ending", T.DateType()),
    T.StructField("streams_actual", T.LongType()),
    T.StructField("streams_predicted", T.DoubleType()),
    T.StructField("is_forecast", T.IntegerType()),
    T.StructField("model_file", T.StringType()),
])

FORECAST_OUTPUT = T.StructType([
    T.StructField("series", T.StringType()),
    T.StructField("ts", T.DateType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("forecast", T.DoubleType()),
    T.StructField("lower_bound", T.DoubleType()),
    T.StructField("upper_bound", T.DoubleType()),
])

COST_PARAMS = T.StructType([
    T.StructField("param_name", T.StringType()),
    T.StructField("param_value", T.DoubleType()),
    T.StructField("updated_at", T.TimestampType()),
])

QUERY_HISTORY = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("warehouse_name", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("total_elapsed_time", T.LongType()),
    T.StructField("execution_status", T.StringType()),
    T.StructField("query_tag", T.StringType()),
    T.StructField("query_text", T.StringType()),
    T.StructField("queued_overload_time", T.LongType()),
    T.StructField("queued_provisioning_time", T.LongType()),
    T.StructField("queued_repair_time", T.LongType()),
    T.StructField("bytes_scanned", T.LongType()),
    T.StructField("rows_produced", T.LongType()),
    T.StructField("end_time", T.TimestampNTZType()),
])

METERING_HISTORY = T.StructType([
    T.StructField("warehouse_name", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("credits_used", T.DecimalType(18, 6)),
])

LOAD_HISTORY = T.StructType([
    T.StructField("warehouse_name", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("avg_running", T.DoubleType()),
    T.StructField("avg_queued_load", T.DoubleType()),
    T.StructField("avg_queued_provisioning", T.DoubleType()),
    T.StructField("avg_blocked", T.DoubleType()),
])

REGISTRY = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("version_name", T.StringType()),
    T.StructField("artifact", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

FEATURE_VIEWS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("entity_keys", T.StringType()),
    T.StructField("timestamp_col", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to exactly ``schema`` (column order and types)."""
    from pyspark.sql import functions as F
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
