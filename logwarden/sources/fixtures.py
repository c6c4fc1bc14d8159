"""Log rows derived from the supplied ``events`` table.

No log table ships with the test data, so logs are a projection of ``events``
(one log per event, same order and volume). The projection is pure Catalyst,
so scans keep column pruning and predicate pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..session import pin_utc


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_to_logs(events: DataFrame) -> DataFrame:
    """events -> LOG_SCHEMA columns.

    * timestamp: ``ts`` as TIMESTAMP (a watermark refuses TIMESTAMP_NTZ)
    * level: error -> ERROR, signup -> WARN, everything else -> INFO
    * message: event type and props joined by a space
    * relatedObjectId: ``EVT-<event_id>``
    * serviceName: by ``user_id % 3`` over the three service names
    """
    et = F.col("event_type")
    level = (F.when(et == "error", F.lit(C.LEVEL_ERROR))
             .when(et == "signup", F.lit(C.LEVEL_WARN))
             .otherwise(F.lit(C.LEVEL_INFO)))
    bucket = F.col("user_id") % 3
    service = (F.when(bucket == 0, F.lit(C.SERVICE_NAMES[0]))
               .when(bucket == 1, F.lit(C.SERVICE_NAMES[1]))
               .otherwise(F.lit(C.SERVICE_NAMES[2])))
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        level.alias("level"),
        F.concat_ws(" ", et, F.col("props")).alias("message"),
        F.concat(F.lit("EVT-"), F.col("event_id").cast("string")).alias("relatedObjectId"),
        service.alias("serviceName"),
    )


def load_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log table of a test-data folder."""
    pin_utc(spark)
    return events_to_logs(read_events(spark, sf_dir))
