"""The detector job: train or reuse a model, then run detection on a stream.

    python -m logwarden.jobs --records /data/logs-topic --model /shared/model \\
        --store /shared/alerts [--servers host:9092] [--window "15 minutes"]

Training reads the whole topic once, writes the decoded logs to the training
snapshot table and trains from that stored table (one topic scan, not one per
fit pass). Detection reads the topic as a stream, scores on the model's own
window width and appends alerts to the store (and, optionally, a topic).
"""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from . import constants as C
from .functions import seconds
from .operators.model import ModelBundle, ensure_model
from .session import build_session, scratch_path
from .sinks.snapshot import read_snapshot, snapshot_logs
from .sinks.topic import alert_publisher
from .sources.codec import decode_logs
from .sources.topic import read_topic, read_topic_stream
from .streaming.detector import checkpoint_location, logs_from_records, start_detection


@dataclass
class DetectorConfig:
    model_path: str
    store_path: str
    window: str = C.DETECTION_WINDOW
    training_window: str | None = None      # must equal ``window`` ...
    allow_window_mismatch: bool = False     # ... unless explicitly allowed
    servers: str | None = None              # Kafka; else record files below
    topic: str = C.LOGS_TOPIC
    records_path: str | None = None
    records_format: str = "parquet"
    snapshot_path: str | None = None
    jdbc_url: str | None = None
    jdbc_table: str = "training_logs"
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    jdbc_driver: str | None = None
    output_mode: str = "update"             # "append": alerts on final counts only
    watermark: str | None = None            # default: the window width
    state_partitions: int | None = None     # of the stream's state, fixed at first start
    fail_on_data_loss: bool = True          # Kafka: lost offsets fail the stream
    alerts_servers: str | None = None
    alerts_topic: str = C.ALERTS_TOPIC
    alerts_path: str | None = None
    checkpoint: str | None = None
    trigger: dict = field(default_factory=lambda: {"processingTime": C.TRIGGER_INTERVAL})
    max_offsets_per_trigger: int | None = None
    max_files_per_trigger: int | None = None
    min_partitions: int | None = None       # Kafka: split partitions over more tasks
    starting_offsets: str | None = None      # Kafka: latest


def training_logs(spark: SparkSession, cfg: DetectorConfig) -> DataFrame:
    """Topic (earliest..latest) -> decoded logs -> snapshot files -> stored logs.
    With ``jdbc_url`` the stored files are also copied to a database table;
    training always reads the files."""
    records = read_topic(spark, servers=cfg.servers, topic=cfg.topic,
                         path=cfg.records_path, fmt=cfg.records_format,
                         min_partitions=cfg.min_partitions)
    logs = decode_logs(records)
    path = cfg.snapshot_path or scratch_path(spark, "training-logs")
    snapshot_logs(logs, path=path)
    stored = read_snapshot(spark, path=path)
    if cfg.jdbc_url:
        snapshot_logs(stored, jdbc_url=cfg.jdbc_url, table=cfg.jdbc_table, user=cfg.jdbc_user,
                      password=cfg.jdbc_password, driver=cfg.jdbc_driver)
    return stored


def ensure_detector_model(spark: SparkSession, cfg: DetectorConfig) -> ModelBundle:
    """One width for training and detection, unless a different training
    width is asked for with ``allow_window_mismatch``."""
    train_window = cfg.training_window or cfg.window
    if seconds(train_window) != seconds(cfg.window) and not cfg.allow_window_mismatch:
        raise ValueError("training and detection window widths differ "
                         f"({cfg.training_window!r} vs {cfg.window!r})")
    return ensure_model(spark, cfg.model_path, lambda: training_logs(spark, cfg),
                        train_window)


def start_detector(spark: SparkSession, cfg: DetectorConfig) -> StreamingQuery:
    bundle = ensure_detector_model(spark, cfg)
    records = read_topic_stream(
        spark, servers=cfg.servers, topic=cfg.topic, path=cfg.records_path,
        fmt=cfg.records_format, starting_offsets=cfg.starting_offsets,
        max_offsets_per_trigger=cfg.max_offsets_per_trigger,
        max_files_per_trigger=cfg.max_files_per_trigger,
        min_partitions=cfg.min_partitions, fail_on_data_loss=cfg.fail_on_data_loss)
    publish = None
    if cfg.alerts_servers or cfg.alerts_path:
        publish = alert_publisher(servers=cfg.alerts_servers, topic=cfg.alerts_topic,
                                  path=cfg.alerts_path)
    ckpt = cfg.checkpoint or checkpoint_location(spark, "anomaly-detection-stream")
    return start_detection(logs_from_records(records), bundle, cfg.store_path, ckpt,
                           trigger=cfg.trigger, publish=publish,
                           query_name="anomaly_detection", window=cfg.window,
                           output_mode=cfg.output_mode, watermark=cfg.watermark,
                           state_partitions=cfg.state_partitions)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--model", required=True)
    p.add_argument("--store", required=True)
    p.add_argument("--window", default=C.DETECTION_WINDOW)
    p.add_argument("--training-window")
    p.add_argument("--allow-window-mismatch", action="store_true")
    p.add_argument("--servers")
    p.add_argument("--topic", default=C.LOGS_TOPIC)
    p.add_argument("--records", help="record files instead of Kafka")
    p.add_argument("--records-format", default="parquet")
    p.add_argument("--snapshot")
    p.add_argument("--jdbc-url", help="also copy the training logs to this database")
    p.add_argument("--jdbc-table", default="training_logs")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", help="environment variable that holds the password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--output-mode", choices=("update", "append"), default="update")
    p.add_argument("--watermark")
    p.add_argument("--state-partitions", type=int)
    p.add_argument("--allow-data-loss", action="store_true",
                   help="go on when Kafka has lost offsets")
    p.add_argument("--alerts-servers")
    p.add_argument("--alerts-path")
    p.add_argument("--checkpoint")
    p.add_argument("--trigger", default=C.TRIGGER_INTERVAL,
                   help="processing-time interval, or 'available-now'")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--min-partitions", type=int)
    p.add_argument("--master")
    a = p.parse_args(argv)
    trigger = ({"availableNow": True} if a.trigger == "available-now"
               else {"processingTime": a.trigger})
    cfg = DetectorConfig(model_path=a.model, store_path=a.store, window=a.window,
                         training_window=a.training_window,
                         allow_window_mismatch=a.allow_window_mismatch,
                         servers=a.servers, topic=a.topic, records_path=a.records,
                         records_format=a.records_format, snapshot_path=a.snapshot,
                         jdbc_url=a.jdbc_url, jdbc_table=a.jdbc_table, jdbc_user=a.jdbc_user,
                         jdbc_password=(os.environ[a.jdbc_password_env]
                                        if a.jdbc_password_env else None),
                         jdbc_driver=a.jdbc_driver, output_mode=a.output_mode,
                         watermark=a.watermark, state_partitions=a.state_partitions,
                         fail_on_data_loss=not a.allow_data_loss, alerts_servers=a.alerts_servers,
                         alerts_path=a.alerts_path, checkpoint=a.checkpoint,
                         trigger=trigger, max_offsets_per_trigger=a.max_offsets_per_trigger,
                         min_partitions=a.min_partitions,
                         starting_offsets="earliest" if a.records else "latest")
    spark = build_session(a.master)
    query = start_detector(spark, cfg)
    query.awaitTermination()
    if query.exception() is not None:
        raise SystemExit(str(query.exception()))


if __name__ == "__main__":
    main()
