"""Alert store: versioned append, read of the last value, compaction.

The store is a parquet table partitioned by the UTC date of the alert window.
An alert is named by its window, service and severity. An insert appends a new
version of an alert whose values changed and nothing for one that did not, so
a resend or a retried micro-batch adds no row, while a window that is emitted
again with another rate takes the place of the earlier value. Reading keeps
the highest version of each alert. Rows are never updated in place, which
makes compaction simple: it adds one file set with the live rows of the files
it has seen and then removes exactly those files.

An alert can be withdrawn: a version with the mark ``withdrawn`` follows, and
reading leaves the alert out until a later version raises it again. So an alert
is open (first version), refreshed (further versions) or withdrawn, and the
store itself is the state: it survives restarts, and a retried batch finds what
it has written.
"""

from __future__ import annotations

import time
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ALERT_COLUMNS, ALERT_SCHEMA
from ..session import child_names, delete_path, path_exists, write_text

PARTITION_COLUMN = "window_date"
VERSION_COLUMN = "version"
WITHDRAWN_COLUMN = "withdrawn"
ROWS_PER_FILE = 1_000_000

STORE_SCHEMA = T.StructType(list(ALERT_SCHEMA.fields)
                            + [T.StructField(VERSION_COLUMN, T.LongType(), True),
                               T.StructField(WITHDRAWN_COLUMN, T.BooleanType(), True),
                               T.StructField(PARTITION_COLUMN, T.DateType(), True)])


def window_date(ts_col: str = "window_start") -> Column:
    """UTC calendar day of a window start, independent of the session time
    zone (a zone-dependent day would let two jobs file one alert under two
    dates, and the check per date would then miss it)."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.col(ts_col)) / 86400).cast("int"))


def _name(prefix: str = "") -> list[Column]:
    """The columns that name an alert, as plain comparable values (a null
    service differs from an empty one)."""
    c = lambda n: F.col(f"{prefix}{n}")
    service = c("metadata")["serviceName"]
    return [F.unix_micros(c("window_start")), F.unix_micros(c("window_end")),
            service.isNull(), F.coalesce(service, F.lit("")), c("severity")]


_NAME = [f"_k{i}" for i in range(5)]


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumns(dict(zip(_NAME, _name())))


def empty_alerts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ALERT_SCHEMA)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).parquet(path)


def _last(rows: DataFrame) -> DataFrame:
    """The highest version of each alert (the later insert on a tie)."""
    columns = [c for c in rows.columns if c not in (*_NAME, PARTITION_COLUMN)]
    best = F.max_by(F.struct(*columns), F.struct(VERSION_COLUMN, "timestamp", "id"))
    return (_named(rows).groupBy(PARTITION_COLUMN, *_NAME).agg(best.alias("a"))
            .select("a.*", PARTITION_COLUMN))


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Every stored alert (ALERT_SCHEMA) with its last value. A store that does
    not exist yields an empty table; any other read error is raised."""
    if not path_exists(spark, path):
        return empty_alerts(spark)
    return _last(_rows(spark, path)).filter(_open()).select(*ALERT_COLUMNS)


def _open() -> Column:
    """Not withdrawn (files written without the mark hold open alerts)."""
    return ~F.coalesce(F.col(WITHDRAWN_COLUMN), F.lit(False))


def alert_states(spark: SparkSession, path: str) -> DataFrame:
    """Every alert ever stored with its state: ``open`` (as first raised),
    ``refreshed`` (raised again with other values) or ``withdrawn``."""
    if not path_exists(spark, path):
        return empty_alerts(spark).withColumn("state", F.lit("open"))
    state = (F.when(~_open(), F.lit("withdrawn")).when(F.col(VERSION_COLUMN) > 0, F.lit("refreshed"))
             .otherwise(F.lit("open")))
    return _last(_rows(spark, path)).select(*ALERT_COLUMNS, state.alias("state"))


def withdraw_alerts(spark: SparkSession, judged: DataFrame, alerts: DataFrame, path: str) -> None:
    """Withdraw the open alerts of windows that have been judged again and do not
    raise them any more.

    ``judged``: window_start, window_end and serviceName of the windows judged
    (one row each); ``alerts``: the alerts that they raise. The dates of the
    windows prune the read of the store, and only alert rows are joined with."""
    if not path_exists(spark, path):
        return
    windows = judged.select(
        F.unix_micros("window_start").alias(_NAME[0]), F.unix_micros("window_end").alias(_NAME[1]),
        F.col("serviceName").isNull().alias(_NAME[2]), F.coalesce("serviceName", F.lit("")).alias(_NAME[3]),
        window_date().alias(PARTITION_COLUMN)).persist()
    try:
        lo, hi = windows.agg(F.min(PARTITION_COLUMN), F.max(PARTITION_COLUMN)).first()
        if lo is None:
            return
        stored = _named(_last(_rows(spark, path).filter(
            F.col(PARTITION_COLUMN).between(F.lit(lo), F.lit(hi)))).filter(_open()))
        raised = _named(alerts.select(*ALERT_COLUMNS)).select(*_NAME)
        gone = stored.join(windows, [PARTITION_COLUMN, *_NAME[:4]], "left_semi").join(
            raised, _NAME, "left_anti")
        gone = gone.select(*[F.current_timestamp().alias(c) if c == "timestamp" else c for c in ALERT_COLUMNS],
                           (F.col(VERSION_COLUMN) + 1).alias(VERSION_COLUMN),
                           F.lit(True).alias(WITHDRAWN_COLUMN), PARTITION_COLUMN).persist()
        try:
            out = sized_by_date(gone)
            if out is not None:
                out.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path)
        finally:
            gone.unpersist()
    finally:
        windows.unpersist()


def insert_alerts(spark: SparkSession, alerts: DataFrame, path: str,
                  publish: Callable[[DataFrame], None] | None = None,
                  unique: bool = False) -> None:
    """Store new alerts and new values of stored ones.

    ``unique`` says that ``alerts`` has one row per alert (as a micro-batch of
    the feature stream has); otherwise one is chosen. The dates of the rows
    prune the read of the store. The rows to store are persisted once: they are
    counted per date, published (optional) and written.

    ``publish`` receives the rows before they are stored, so a failure between
    the two steps re-publishes on retry (at least once on the topic) but never
    stores twice.
    """
    fresh = _named(alerts.select(*ALERT_COLUMNS).withColumn(PARTITION_COLUMN, window_date()))
    if not unique:
        fresh = fresh.dropDuplicates(_NAME)
    fresh = fresh.persist()
    try:
        lo, hi = fresh.agg(F.min(PARTITION_COLUMN), F.max(PARTITION_COLUMN)).first()
        if lo is None:
            return
        if path_exists(spark, path):
            stored = _named(_last(_rows(spark, path).filter(
                F.col(PARTITION_COLUMN).between(F.lit(lo), F.lit(hi))))).select(
                    PARTITION_COLUMN, *_NAME, F.col(VERSION_COLUMN).alias("_seen"),
                    F.col("metadata.errorRate").alias("_rate"), F.col("description").alias("_text"),
                    _open().alias("_live"))
            met = fresh.join(stored, [PARTITION_COLUMN, *_NAME], "left")
            same = F.col("_seen").isNotNull() & F.col("_live") & F.col("metadata.errorRate").eqNullSafe(
                F.col("_rate")) & F.col("description").eqNullSafe(F.col("_text"))
            new = met.filter(~same).withColumn(VERSION_COLUMN, F.coalesce(F.col("_seen") + 1, F.lit(0)))
        else:
            new = fresh.withColumn(VERSION_COLUMN, F.lit(0).cast("long"))
        new = new.select(*ALERT_COLUMNS, VERSION_COLUMN, F.lit(False).alias(WITHDRAWN_COLUMN),
                         PARTITION_COLUMN).persist()
        try:
            out = sized_by_date(new)
            if out is None:
                return
            if publish is not None:
                publish(out.select(*ALERT_COLUMNS))
            out.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path)
        finally:
            new.unpersist()
    finally:
        fresh.unpersist()


def sized_by_date(rows: DataFrame, rows_per_file: int | None = None) -> DataFrame | None:
    """Rows laid out for a write by date: each date goes to as many tasks as
    its own row count asks for (one file for a quiet day, many for an incident
    day), counted explicitly so that it also holds inside a stream, where the
    plan is not adapted at run time. None without rows."""
    per_file = rows_per_file or ROWS_PER_FILE
    counts = rows.groupBy(PARTITION_COLUMN).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(per_file)).cast("int").alias("_files"))
    tasks, most = counts.agg(F.sum("_files"), F.max("_files")).first()
    if tasks is None:
        return None
    if most == 1:                        # one file for each date: no salts to look up
        return rows.repartition(int(tasks), PARTITION_COLUMN)
    salt = F.pmod(F.xxhash64("id", "window_start"), F.col("_files"))
    return rows.join(counts, PARTITION_COLUMN).repartition(
        int(tasks), PARTITION_COLUMN, salt).drop("_files")


#: Lists of files that a compaction has replaced (readers skip the folder).
RETIRED = "_retired"


def _retired(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Lists of replaced files that are still there, by name."""
    base = f"{path.rstrip('/')}/{RETIRED}"
    names = [n for n in child_names(spark, base) if n.endswith(".txt") and not n.startswith(".")]
    return {n: [r[0] for r in spark.read.text(f"{base}/{n}").collect()] for n in names}


def purge_retired(spark: SparkSession, path: str, grace_s: float = 0.0) -> int:
    """Delete files replaced more than ``grace_s`` seconds ago; returns their
    number. A list goes after its files, so a crash in between is made good by
    the next call."""
    deleted = 0
    for name, files in _retired(spark, path).items():
        if int(name.split("-")[0]) <= (time.time() - grace_s) * 1000:
            for f in files:
                delete_path(spark, f)
            delete_path(spark, f"{path.rstrip('/')}/{RETIRED}/{name}")
            deleted += len(files)
    return deleted


def compact_alerts(spark: SparkSession, path: str, before,
                   rows_per_file: int | None = None, grace_s: float = 0.0) -> None:
    """Rewrite the dates older than ``before`` into files of about
    ``rows_per_file`` rows, holding the last value of each alert.

    The live rows of the files found now are appended as new files; only then
    are exactly those files retired. An insert that runs meanwhile writes other
    files and keeps its rows; a crash before that leaves each row twice under
    one version, which reading resolves and the next compaction removes.

    With ``grace_s`` the replaced files stay that many seconds, for readers that
    have listed them already (rows then stand twice under one version, too), and
    go with the first compaction or ``purge_retired`` after it. Without, such
    a reader fails and must read again.
    """
    if not path_exists(spark, path):
        return
    purge_retired(spark, path, grace_s)
    gone = {f for files in _retired(spark, path).values() for f in files}
    old = _rows(spark, path).filter(F.col(PARTITION_COLUMN) < F.lit(before).cast("date"))
    files = [r[0] for r in old.select(F.input_file_name()).distinct().collect() if r[0] not in gone]
    if not files:
        return
    seen = spark.read.schema(STORE_SCHEMA).option("basePath", path).parquet(*files)
    live = _last(seen).persist()
    try:
        out = sized_by_date(live, rows_per_file)
        if out is not None:
            out.select(*ALERT_COLUMNS, VERSION_COLUMN, WITHDRAWN_COLUMN, PARTITION_COLUMN).write.mode("append") \
                .partitionBy(PARTITION_COLUMN).parquet(path)
    finally:
        live.unpersist()
    if grace_s > 0:
        name = f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}.txt"
        write_text(spark, f"{path.rstrip('/')}/{RETIRED}/{name}", "\n".join(files) + "\n")
        return
    for f in files:
        delete_path(spark, f)
