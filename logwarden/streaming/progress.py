"""Progress of a stream kept as rows: what each micro-batch admitted, and when.

A ``ProgressRecorder`` listens to a session's streams and writes one small JSON
file per batch to a shared folder, named by query and batch, so a batch that runs
again replaces its own row and nothing is lost when the driver goes (a query's own
``recentProgress`` holds the last 100 batches in memory). The event has the row
already, so no Spark job runs in the listener.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..session import child_names, write_text

PROGRESS_SCHEMA = T.StructType([
    T.StructField("query_id", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("started", T.TimestampType()),        # start of the trigger
    T.StructField("input_rows", T.LongType()), T.StructField("batch_ms", T.LongType()),
    T.StructField("watermark", T.TimestampType()),      # null without one
    T.StructField("state_rows", T.LongType()), T.StructField("late_rows_dropped", T.LongType()),
    T.StructField("start_offset", T.StringType()), T.StructField("end_offset", T.StringType()),
])


def progress_row(progress) -> dict:
    """A StreamingQueryProgress as a row of PROGRESS_SCHEMA (sources and state
    operators summed; offsets as a JSON list, one entry a source)."""
    ops = progress.stateOperators
    return {"query_id": str(progress.id), "run_id": str(progress.runId), "name": progress.name,
            "batch_id": progress.batchId, "started": progress.timestamp,
            "input_rows": sum(s.numInputRows for s in progress.sources),
            "batch_ms": progress.batchDuration, "watermark": progress.eventTime.get("watermark"),
            "state_rows": sum(o.numRowsTotal for o in ops),
            "late_rows_dropped": sum(o.numRowsDroppedByWatermark for o in ops),
            "start_offset": json.dumps([s.startOffset for s in progress.sources]),
            "end_offset": json.dumps([s.endOffset for s in progress.sources])}


class ProgressRecorder(StreamingQueryListener):
    """Writes the progress of every stream of the session below ``path``::

        with ProgressRecorder(spark, path) as recorder:
            query = start(...)
            recorder.wait(query)
        read_progress(spark, path)

    Events reach a listener some time after the batch; ``wait`` returns once the
    query has ended and its last event is written. A write that fails is raised
    by ``wait``, not swallowed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._ended: dict[str, threading.Event] = {}
        self._lock, self._failure = threading.Lock(), None

    def __enter__(self) -> ProgressRecorder:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = progress_row(event.progress)
        try:
            write_text(self.spark, f"{self.path}/{row['query_id']}/{row['batch_id']:012d}.json",
                       json.dumps(row) + "\n")
        except Exception as e:                     # raised by wait()
            self._failure = self._failure or e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, query: StreamingQuery, timeout_s: float = 60.0) -> None:
        """Until ``query`` has ended (its failure is raised) and all its progress
        is written."""
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        if not self._end(query.runId).wait(timeout_s):
            raise TimeoutError("the stream's last events have not arrived")
        if self._failure is not None:
            raise self._failure


def run_until_caught_up(query: StreamingQuery) -> StreamingQuery:
    """For a stream on a processing-time trigger: until all that has arrived is
    processed, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Recorded batches (PROGRESS_SCHEMA); none for a folder without any."""
    if not child_names(spark, path):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).json(f"{path.rstrip('/')}/*")


def trigger_gaps(progress: DataFrame) -> DataFrame:
    """Per query: batches with input, the most rows one admitted, and first and
    last trigger start. One aggregate; nothing is sorted."""
    fed = progress.filter(F.col("input_rows") > 0)
    return fed.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("batches"), F.max("input_rows").alias("most_rows"),
        F.min("started").alias("first_start"), F.max("started").alias("last_start"))
