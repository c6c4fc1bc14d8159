"""Log topic sources (batch and streaming).

The production source is a Kafka topic (``format("kafka")``, connector jar on
the class path). Offline the same ``key, value`` records sit in parquet or JSON
files; both go through one reader so every later operator is source-agnostic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from ..schemas import RECORD_SCHEMA


def _kafka_options(servers: str, topic: str, starting_offsets: str,
                   fail_on_data_loss: bool) -> dict:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def read_topic(spark: SparkSession, *, servers: str | None = None,
               topic: str = C.LOGS_TOPIC, path: str | None = None,
               fmt: str = "parquet", starting_offsets: str = "earliest",
               fail_on_data_loss: bool = False,
               min_partitions: int | None = None) -> DataFrame:
    """Batch scan of the whole topic, earliest to latest.

    Nothing is capped: a batch read takes every record in the offset range
    (``maxOffsetsPerTrigger`` is a streaming option and is not passed here).
    ``min_partitions`` splits large Kafka partitions over more tasks.
    """
    if servers:
        r = (spark.read.format("kafka")
             .options(**_kafka_options(servers, topic, starting_offsets,
                                       fail_on_data_loss)))
        if min_partitions:
            r = r.option("minPartitions", str(min_partitions))
        return r.load()
    if path is None:
        raise ValueError("either servers (Kafka) or path (record files) is required")
    reader = spark.read.format(fmt)
    if fmt != "parquet":
        reader = reader.schema(RECORD_SCHEMA)
    return reader.load(path)


def read_topic_stream(spark: SparkSession, *, servers: str | None = None,
                      topic: str = C.LOGS_TOPIC, path: str | None = None,
                      fmt: str = "parquet", schema=None,
                      starting_offsets: str | None = None,
                      max_offsets_per_trigger: int | None = None,
                      max_files_per_trigger: int | None = None,
                      fail_on_data_loss: bool = True,
                      min_partitions: int | None = None) -> DataFrame:
    """Streaming scan. Rate limits apply per micro-batch: offsets for Kafka,
    files for a file source. Lost offsets fail the query unless
    ``fail_on_data_loss`` is switched off on purpose.

    ``starting_offsets`` (Kafka; default ``latest``) has no meaning for files,
    which are read from the first on: asking for it there is an error, and so
    is a limit of the other kind of source."""
    if servers:
        if max_files_per_trigger:
            raise ValueError("max_files_per_trigger limits files, not a Kafka topic")
        r = (spark.readStream.format("kafka")
             .options(**_kafka_options(servers, topic, starting_offsets or "latest",
                                       fail_on_data_loss)))
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        if min_partitions:
            r = r.option("minPartitions", str(min_partitions))
        return r.load()
    if path is None:
        raise ValueError("either servers (Kafka) or path (record files) is required")
    if starting_offsets not in (None, "earliest"):
        raise ValueError(f"a topic of files is read from the first file on, not from {starting_offsets!r}")
    if max_offsets_per_trigger:
        raise ValueError("max_offsets_per_trigger limits a Kafka topic, not files")
    r = spark.readStream.format(fmt).schema(schema or RECORD_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
