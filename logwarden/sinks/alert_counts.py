"""Severity counts kept by date beside the alert store.

Each date of the store has one row of counts in its own folder. A refresh reads
only the store's files of the dates it is given (those that an insert, a
withdrawal or a compaction touched) and replaces their rows, so a refreshed or
withdrawn alert leaves the count it was in. The totals are sums over one row a
date, however many alerts the store holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..session import path_exists
from .alert_store import PARTITION_COLUMN, _last, _open, _rows, window_date

_COUNTS = {"high_count": C.SEVERITY_HIGH, "medium_count": C.SEVERITY_MEDIUM, "low_count": C.SEVERITY_LOW}
_SCHEMA = ", ".join(f"{c} long" for c in _COUNTS)


def alert_dates(alerts: DataFrame) -> DataFrame:
    """(window_date) of the alerts (or judged windows): the dates they touch."""
    return alerts.select(window_date().alias(PARTITION_COLUMN)).distinct()


def refresh_counts(spark: SparkSession, store: str, counts: str, dates: DataFrame) -> None:
    """Count the given dates of the store anew; a date without alerts gets zeros.
    The dates come to the driver to prune the read: one value a day."""
    days = sorted(r[0] for r in dates.select(PARTITION_COLUMN).distinct().collect() if r[0] is not None)
    if not days:
        return
    asked = spark.createDataFrame([(d,) for d in days], f"{PARTITION_COLUMN} date")
    found = asked.select(PARTITION_COLUMN, F.lit(None).cast("string").alias("severity"))
    if path_exists(spark, store):
        held = _last(_rows(spark, store).filter(F.col(PARTITION_COLUMN).isin(days))).filter(_open())
        found = found.unionByName(held.select(PARTITION_COLUMN, "severity"))
    rows = found.groupBy(PARTITION_COLUMN).agg(
        *[F.count_if(F.col("severity") == s).alias(c) for c, s in _COUNTS.items()])
    rows.repartition(PARTITION_COLUMN).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COLUMN).parquet(counts)


def stored_severity_counts(spark: SparkSession, counts: str) -> DataFrame:
    """One row: HIGH, MEDIUM and LOW counts (zeros without any date)."""
    if path_exists(spark, counts):
        rows = spark.read.schema(_SCHEMA).parquet(counts)
    else:
        rows = spark.createDataFrame([], _SCHEMA)
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in _COUNTS])
