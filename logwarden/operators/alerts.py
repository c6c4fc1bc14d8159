"""Alert gates, alert records, listing and severity counts.

The gates only need columns of the feature row plus the cluster id, so the
whole path from scored features to alert rows is one projection + filter:
no collect, no per-row send, no union of the two severities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import alert_description, alert_id, alert_metadata, display_time


def medium_gate(prediction: str = "prediction") -> Column:
    return ((F.col(prediction) == F.lit(C.MEDIUM_CLUSTER))
            & (F.col("error_rate") > F.lit(C.MEDIUM_MIN_ERROR_RATE))
            & (F.col("total_logs") > F.lit(C.MIN_TOTAL_LOGS)))


def high_gate(prediction: str = "prediction") -> Column:
    return ((F.col(prediction) == F.lit(C.HIGH_CLUSTER))
            & (F.col("error_rate") > F.lit(C.HIGH_MIN_ERROR_RATE))
            & (F.col("total_logs") > F.lit(C.MIN_TOTAL_LOGS)))


def severity(prediction: str = "prediction") -> Column:
    """HIGH / MEDIUM / null. The two gates need different cluster ids, so a
    row passes at most one of them."""
    return (F.when(high_gate(prediction), F.lit(C.SEVERITY_HIGH))
            .when(medium_gate(prediction), F.lit(C.SEVERITY_MEDIUM)))


def pre_gate(features: DataFrame) -> DataFrame:
    """Filters that do not depend on the model (error rate above the lower
    threshold, enough logs); applying them before scoring is equivalent."""
    return features.filter(
        (F.col("error_rate") > F.lit(min(C.MEDIUM_MIN_ERROR_RATE, C.HIGH_MIN_ERROR_RATE)))
        & (F.col("total_logs") > F.lit(C.MIN_TOTAL_LOGS)))


def medium_risk(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    return scored.filter(medium_gate(prediction))


def high_risk(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    return scored.filter(high_gate(prediction))


def gated(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Scored rows that raise an alert, with their ``severity``. The plain
    predicates come first, so distances are computed for few rows."""
    return (pre_gate(scored).withColumn("severity", severity(prediction))
            .filter(F.col("severity").isNotNull()))


def alert_rows(gated_rows: DataFrame, now: Column | None = None) -> DataFrame:
    """ALERT_SCHEMA rows. ``timestamp`` is the insert time (current time unless
    given); it is never part of the id."""
    ts = now if now is not None else F.current_timestamp()
    return gated_rows.select(
        alert_id("window_start", "window_end", "serviceName", "severity").alias("id"),
        ts.alias("timestamp"),
        F.lit(C.ALERT_TYPE).alias("type"),
        F.col("severity"),
        F.lit(C.ALERT_SOURCE).alias("source"),
        alert_description("serviceName", "error_rate").alias("description"),
        alert_metadata("serviceName", "error_rate").alias("metadata"),
        F.col("window_start"),
        F.col("window_end"),
    )


def alert_records(scored: DataFrame, prediction: str = "prediction",
                  now: Column | None = None) -> DataFrame:
    return alert_rows(gated(scored, prediction), now)


def alert_listing(alerts: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """What the alert page shows: id, formatted time, type, severity, source,
    description (store order; no sort)."""
    return alerts.select(
        F.col("id"),
        display_time(time_col).alias("time"),
        F.col("type"),
        F.col("severity"),
        F.col("source"),
        F.col("description"),
    )


def severity_counts(alerts: DataFrame) -> DataFrame:
    """One row: HIGH, MEDIUM and LOW counts (zeros included; other values
    ignored). A global aggregate with partial counts per task."""
    s = F.col("severity")
    return alerts.agg(
        F.count_if(s == F.lit(C.SEVERITY_HIGH)).alias("high_count"),
        F.count_if(s == F.lit(C.SEVERITY_MEDIUM)).alias("medium_count"),
        F.count_if(s == F.lit(C.SEVERITY_LOW)).alias("low_count"),
    )
