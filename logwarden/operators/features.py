"""Per-window, per-service log features (batch or stream, same code).

Plan shape: scan -> project -> partial hash aggregate -> one exchange on
(window, serviceName) -> final aggregate. Partial aggregation collapses every
(window, service) group inside each map task before the shuffle, so a hot
service holding a large share of all logs costs one partial row per task and
window, not a skewed shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import error_marker, error_rate, message_length


def window_features(logs: DataFrame, window: str = "15 minutes",
                    time_col: str = "timestamp",
                    watermark: str | None = None) -> DataFrame:
    """FEATURE_SCHEMA rows: window_start, window_end, serviceName, total_logs,
    error_count, avg_message_length, error_rate (percent, 2 decimals).

    The group key is the window *struct*: keeping it (and projecting ``start``
    only after the aggregate) is what lets a watermark bound streaming state
    and drop late rows. Rows with a null time stamp fall out of every window.
    """
    if watermark is not None:
        logs = logs.withWatermark(time_col, watermark)
    grouped = logs.groupBy(F.window(F.col(time_col), window).alias("window"),
                           F.col("serviceName"))
    agg = grouped.agg(
        F.count(F.lit(1)).alias("total_logs"),
        F.count(error_marker("level")).alias("error_count"),
        F.avg(message_length("message")).alias("avg_message_length"),
    )
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("serviceName"),
        F.col("total_logs"),
        F.col("error_count"),
        F.col("avg_message_length"),
        error_rate("error_count", "total_logs").alias("error_rate"),
    )


def prepare_features(logs: DataFrame, window: str = "5 minutes") -> DataFrame:
    """The training-side feature table (the original trained on 5-minute
    windows); identical computation with its own default width."""
    return window_features(logs, window)
