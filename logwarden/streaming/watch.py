"""Watching the streams: silent services, late rows, and the state itself.

* A service is silent between two sessions of its logs: session windows close
  by event time, so a silence is known as soon as the watermark passes the gap.
* Late rows are accounted for instead of vanishing in the aggregate: a batch
  splits into rows on time and rows with the reason why they are not.
* The state of a feature stream is read back from its checkpoint, to compare the
  windows it holds open with what the logs say.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import seconds
from ..session import path_exists
from .detector import DEFAULT_TRIGGER, _start, _writer

# ---------------------------------------------------------- silent services ---

SESSION_SCHEMA = T.StructType([
    T.StructField("serviceName", T.StringType()), T.StructField("first_log", T.TimestampType()),
    T.StructField("last_log", T.TimestampType()), T.StructField("total_logs", T.LongType())])

_MERGE_LOCALLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def service_sessions(logs: DataFrame, silent_after: str, watermark: str | None = None) -> DataFrame:
    """(serviceName, first_log, last_log, total_logs): runs of logs of a service
    with ``silent_after`` at most between neighbours (batch or stream). A null
    service is a service of its own; logs without a time stamp are in none."""
    if watermark is not None:
        logs = logs.withWatermark("timestamp", watermark)
    grouped = logs.filter(F.col("timestamp").isNotNull()).groupBy(
        F.session_window("timestamp", silent_after).alias("session"), "serviceName")
    return grouped.agg(F.min("timestamp").alias("first_log"), F.max("timestamp").alias("last_log"),
                       F.count(F.lit(1)).alias("total_logs")).select(
        "serviceName", "first_log", "last_log", "total_logs")


def start_session_table(logs_stream: DataFrame, silent_after: str, path: str, checkpoint: str,
                        watermark: str | None = None, trigger: dict | None = None,
                        state_partitions: int | None = None) -> StreamingQuery:
    """Append mode: a session is written once, when the watermark has passed
    ``silent_after`` beyond its last log: from then on the service is known to be
    silent. Sessions merge within each task before the shuffle, so a service
    that sends a third of all logs sends a few rows."""
    spark = logs_stream.sparkSession
    before = spark.conf.get(_MERGE_LOCALLY)
    spark.conf.set(_MERGE_LOCALLY, "true")
    try:
        sessions = service_sessions(logs_stream, silent_after, watermark or silent_after)
        w = (_writer(sessions, "append", trigger or DEFAULT_TRIGGER, checkpoint, None)
             .format("parquet").option("path", path))
        return _start(w, spark, state_partitions)
    finally:
        spark.conf.set(_MERGE_LOCALLY, before)


def silent_services(sessions: DataFrame) -> DataFrame:
    """(serviceName, silent_from, back_at) from closed sessions, one row each:
    the last log before a silence, and the first after it (null while no later
    session has closed). Sessions are few beside the logs: one a silence."""
    return sessions.select("serviceName", F.col("last_log").alias("silent_from"), F.lead("first_log").over(
        Window.partitionBy("serviceName").orderBy("first_log")).alias("back_at"))


# ----------------------------------------------------------------- late rows ---

MARK_SCHEMA = T.StructType([T.StructField("newest", T.TimestampType()), T.StructField("batch_id", T.LongType())])
LATE, UNTIMED = "window_closed", "missing_timestamp"


def late_reason(window: str, watermark_us: int | None):
    """Why a row is in no window that is still open: no time stamp, or its window
    has ended by the watermark. Null for a row on time."""
    width = seconds(window) * 1_000_000
    micros = F.unix_micros("timestamp")
    end = micros - F.pmod(micros, F.lit(width)) + F.lit(width)
    closed = F.lit(False) if watermark_us is None else end <= F.lit(watermark_us)
    return F.when(micros.isNull(), F.lit(UNTIMED)).when(closed, F.lit(LATE))


def _watermark(spark: SparkSession, path: str, before: int, delay: str) -> int | None:
    """Newest event time (to the millisecond, as watermarks are) of the batches
    before ``before`` less the delay, in microseconds."""
    marks = f"{path}/marks"
    if not path_exists(spark, marks):
        return None
    newest = spark.read.schema(MARK_SCHEMA).option("basePath", marks).parquet(marks).filter(
        F.col("batch_id") < before).agg(F.max(F.unix_millis("newest"))).first()[0]
    return None if newest is None else (newest - seconds(delay) * 1000) * 1000


def late_row_accountant(path: str, window: str, delay: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch body over a log stream: rows go to ``path/rows`` with their
    ``reason`` (null: on time), filed by batch and by whether they are late, and the
    batch's newest time to ``path/marks``. The watermark of a batch comes from
    the marks of the batches before it, so a retried or restarted batch splits
    as it did before and replaces its own files."""
    base = path.rstrip("/")

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        mark = _watermark(spark, base, batch_id, delay)
        batch = batch_df.withColumn("reason", late_reason(window, mark)).persist()
        try:
            newest = batch.agg(F.max("timestamp").alias("newest"), F.count(F.lit(1)).alias("rows")).first()
            if not newest["rows"]:
                return
            (batch.withColumn("late", F.col("reason").isNotNull())
             .withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id", "late").parquet(f"{base}/rows"))
            (spark.createDataFrame([(newest["newest"], batch_id)], MARK_SCHEMA).coalesce(1)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(f"{base}/marks"))
        finally:
            batch.unpersist()
    return handle


def start_late_accounting(logs_stream: DataFrame, path: str, window: str, checkpoint: str,
                          delay: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Account for the rows of a log stream; the delay defaults to the width."""
    return (_writer(logs_stream, "append", trigger or DEFAULT_TRIGGER, checkpoint, None)
            .foreachBatch(late_row_accountant(path, window, delay or window)).start())


def accounted_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every row accounted for, with reason, late and batch_id."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows")
    return rows.withColumn("late", F.col("late").cast("boolean"))


# --------------------------------------------------------------------- state ---

def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(window_start, window_end, serviceName, total_logs, error_count) that a
    feature stream holds open, read from its checkpoint by the state data source."""
    state = spark.read.format("statestore").load(checkpoint)
    fields = state.schema["value"].dataType.fields        # partial counts, in the order of the features
    names = ("total_logs", "error_count", *[f"part{i}" for i in range(2, len(fields))])
    value = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields)])
    held = state.select("key", F.col("value").cast(value).alias("value"))
    return held.select(
        F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
        F.col("key.serviceName").alias("serviceName"), "value.total_logs", "value.error_count")
