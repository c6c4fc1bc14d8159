"""Fixed schemas of the data model, declared once and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# A decoded log record. Timestamps on the wire carry no zone; they are read in
# the session time zone, which the library pins to UTC (see session.py).
LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("level", T.StringType(), True),
        T.StructField("message", T.StringType(), True),
        T.StructField("relatedObjectId", T.StringType(), True),
        T.StructField("serviceName", T.StringType(), True),
    ]
)

LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]

# Records as they sit on a log topic (Kafka source layout). Offline sources
# (parquet / json files) use the same columns.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

# One row per (tumbling window, service). window_end is an addition to the
# reference's feature row; it is what alerts and closed-window checks need.
FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType(), True),
        T.StructField("window_end", T.TimestampType(), True),
        T.StructField("serviceName", T.StringType(), True),
        T.StructField("total_logs", T.LongType(), False),
        T.StructField("error_count", T.LongType(), False),
        T.StructField("avg_message_length", T.DoubleType(), True),
        T.StructField("error_rate", T.DoubleType(), True),
    ]
)

# Order of the model's feature vector; it differs from the column order above.
VECTOR_COLUMNS = ["total_logs", "error_count", "error_rate", "avg_message_length"]

METADATA_TYPE = T.StructType(
    [
        T.StructField("serviceName", T.StringType(), True),
        T.StructField("errorRate", T.DoubleType(), True),
    ]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("severity", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("metadata", METADATA_TYPE, True),
        T.StructField("window_start", T.TimestampType(), True),
        T.StructField("window_end", T.TimestampType(), True),
    ]
)

ALERT_COLUMNS = [f.name for f in ALERT_SCHEMA.fields]

# Stored model: scaler statistics and centroids as plain tables.
SCALER_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("mean", T.DoubleType(), False),
        T.StructField("std", T.DoubleType(), False),
    ]
)

CENTROID_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("cluster", T.IntegerType(), False),
        T.StructField("center", T.ArrayType(T.DoubleType(), False), False),
    ]
)

# Target level mix of a log producer (info/warn/error percentages, delay).
MIX_SCHEMA = T.StructType(
    [
        T.StructField("serviceName", T.StringType(), True),
        T.StructField("info_rate", T.IntegerType(), True),
        T.StructField("warn_rate", T.IntegerType(), True),
        T.StructField("error_rate", T.IntegerType(), True),
        T.StructField("delay_ms", T.LongType(), True),
    ]
)
