"""Publishing alerts (and any record frame) to a topic.

With ``servers`` the records go to Kafka (``write.format("kafka")``, the
connector jar must be on the class path); otherwise they are appended as
files with the same ``key, value, topic`` columns, which the topic reader in
``sources.topic`` reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..schemas import ALERT_COLUMNS, ALERT_SCHEMA

def alerts_to_records(alerts: DataFrame, topic: str = C.ALERTS_TOPIC) -> DataFrame:
    """key = alert id (text), value = the alert as JSON (metadata nested, the
    error rate kept as a JSON number)."""
    value = F.to_json(F.struct(*[F.col(c) for c in ALERT_COLUMNS]),
                      {"timestampFormat": C.WIRE_TIME_FORMAT})
    return alerts.select(
        F.col("id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def decode_alert_records(records: DataFrame) -> DataFrame:
    """Topic records back to ALERT_SCHEMA columns (plus the text key)."""
    parsed = F.from_json(F.col("value").cast("string"), ALERT_SCHEMA,
                         {"timestampFormat": C.WIRE_TIME_FORMAT})
    return records.select(F.col("key").cast("string").alias("key"),
                          parsed.alias("a")).select("key", "a.*")


def publish_records(records: DataFrame, *, servers: str | None = None,
                    topic: str = C.ALERTS_TOPIC, path: str | None = None,
                    fmt: str = "parquet", acks: str = "all") -> None:
    if servers:
        (records.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("kafka.acks", acks)
         .option("topic", topic)
         .save())
        return
    if path is None:
        raise ValueError("either servers (Kafka) or path (record files) is required")
    records.write.mode("append").format(fmt).save(path)


def alert_publisher(*, servers: str | None = None, topic: str = C.ALERTS_TOPIC,
                    path: str | None = None, fmt: str = "parquet"):
    """A ``publish`` callback for ``insert_alerts``."""
    def publish(alerts: DataFrame) -> None:
        publish_records(alerts_to_records(alerts, topic), servers=servers,
                        topic=topic, path=path, fmt=fmt)
    return publish

