"""Structured Streaming: windowed features, scoring and alert delivery.

* The watermark is set on the event time and the aggregate groups by the
  window *struct*, so state for closed windows is evicted and rows older than
  the watermark are dropped (grouping by ``window.start`` would silently lose
  the watermark and keep every window in state forever).
* Scoring is plain column expressions (see ``operators.scoring``), so the
  scored stream is the stateful aggregate plus one projection.
* Delivery happens in ``foreachBatch``: the gated rows are inserted into the
  alert store, where the last gated value of an alert wins, so a window that
  is emitted again (update mode) refreshes its alert and a retried batch
  changes nothing.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from ..operators.alerts import alert_records, pre_gate
from ..operators.features import window_features
from ..operators.model import ModelBundle
from ..operators.scoring import score
from ..schemas import FEATURE_SCHEMA
from ..session import (child_names, current_version, delete_path, new_version,
                       publish_version, shared_dir, versions)
from ..sinks.alert_store import insert_alerts, window_date, withdraw_alerts
from ..sources.codec import decode_logs
from ..sources.fixtures import events_to_logs

DEFAULT_TRIGGER = {"processingTime": C.TRIGGER_INTERVAL}


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Stream checkpoints live below the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/logwarden/streams/{name}"


#: The log fields that features need; the others are not parsed.
FEATURE_FIELDS = ("timestamp", "level", "message", "serviceName")


def logs_from_records(records_stream: DataFrame) -> DataFrame:
    """Topic records (Kafka or files) -> decoded log stream (FEATURE_FIELDS)."""
    return decode_logs(records_stream, fields=FEATURE_FIELDS)


def logs_from_event_files(spark: SparkSession, path: str,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Log stream over ``events`` parquet files (a glob or a folder)."""
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return events_to_logs(r.parquet(path))


def stream_features(logs_stream: DataFrame, window: str = C.DETECTION_WINDOW,
                    watermark: str | None = None) -> DataFrame:
    """Stateful tumbling aggregate; the watermark delay defaults to the width."""
    return window_features(logs_stream, window, watermark=watermark or window)


def scored_stream(logs_stream: DataFrame, bundle: ModelBundle,
                  watermark: str | None = None) -> DataFrame:
    """Features on the model's own window width, plus ``prediction``."""
    return score(stream_features(logs_stream, bundle.window, watermark), bundle)


def _writer(df: DataFrame, output_mode: str, trigger: dict, checkpoint: str,
            query_name: str | None):
    w = (df.writeStream.outputMode(output_mode).trigger(**trigger)
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return w


def _start(writer, spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """Start a stream, optionally with its own number of state partitions.

    The count of a stateful stream is taken from ``spark.sql.shuffle.partitions``
    when the query first starts and then frozen in its checkpoint, so it is
    worth choosing on purpose: many for a cluster-sized state, few for a small
    one. The session value is restored right after the start (the stream
    keeps its own copy of the configuration)."""
    if state_partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


# ---------------------------------------------------------------- features ---

def changelog_writer(path: str, rows_per_file: int = 1_000_000
                     ) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for update mode: the batch's changed rows are written
    into partition ``batch_id=<id>`` with dynamic overwrite, so a retried batch
    replaces its own output instead of duplicating it.

    Rows leave the stateful stage in ``spark.sql.shuffle.partitions`` pieces
    and AQE is off inside a stream, so the batch is counted (it is persisted)
    and coalesced to about ``rows_per_file`` rows per file: one file for a
    normal micro-batch, many for a large backfill batch."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch = batch_df.persist()
        try:
            rows = batch.count()
            if rows == 0:                  # nothing changed: write nothing
                return
            files = max(1, -(-rows // rows_per_file))
            (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
             .coalesce(files)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(path))
        finally:
            batch.unpersist()
    return write


def start_feature_changelog(features_stream: DataFrame, path: str, checkpoint: str,
                            trigger: dict | None = None,
                            query_name: str | None = None,
                            state_partitions: int | None = None) -> StreamingQuery:
    """Update mode: every trigger re-emits the windows that changed."""
    w = (_writer(features_stream, "update", trigger or DEFAULT_TRIGGER, checkpoint,
                 query_name)
         .foreachBatch(changelog_writer(path)))
    return _start(w, features_stream.sparkSession, state_partitions)


_KEY = ("window_start", "window_end", "serviceName")
_CHANGELOG_SCHEMA = T.StructType(list(FEATURE_SCHEMA.fields)
                                 + [T.StructField("batch_id", T.LongType(), True)])
_FOLDED_COLUMNS = [f.name for f in _CHANGELOG_SCHEMA.fields]


def _latest(log: DataFrame) -> DataFrame:
    """Row of the highest batch id per (window, service); batch id kept. All
    values have a fixed width, so each is its own ``max_by`` and the plan is a
    hash aggregate without a sort."""
    values = [c for c in log.columns if c not in (*_KEY, "batch_id")]
    return log.groupBy(*_KEY).agg(
        *[F.max_by(c, "batch_id").alias(c) for c in values],
        F.max("batch_id").alias("batch_id"))


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Batch ids written so far, from the folder names."""
    return sorted(int(n.split("=")[1]) for n in child_names(spark, path) if n.startswith("batch_id="))


def _read_batches(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    """The given batches only; other folders are not listed."""
    if not batches:
        return spark.createDataFrame([], _CHANGELOG_SCHEMA)
    base = path.rstrip("/")
    return spark.read.schema(_CHANGELOG_SCHEMA).option("basePath", base).parquet(
        *[f"{base}/batch_id={b}" for b in batches]).select(*_FOLDED_COLUMNS)


def latest_features(spark: SparkSession, path: str) -> DataFrame:
    """Current value of every (window, service) in a changelog: the row of the
    highest batch id. Empty when no batch has been written yet."""
    return _latest(_read_batches(spark, path, _batches(spark, path))).select(
        *[f.name for f in FEATURE_SCHEMA.fields])


def fold_changelog(spark: SparkSession, changelog: str, table: str) -> int | None:
    """Fold every changelog batch written so far into the folded table.

    The folded table keeps one row per (window, service), filed by the window's
    date; its meta maps each date to the version folder that holds it. A fold
    reads the new batches and the dates they touch, writes those dates into a
    new version folder and publishes the new map; other dates stay where they
    are. What the version before the last had needed is then deleted: batches
    folded by it and date folders that neither of the last two versions names
    (a reader that has just read the previous meta still finds its files).
    Returns the batch id folded through (None for an empty changelog)."""
    base = table.rstrip("/")
    meta = current_version(spark, base)
    done = meta["through"] if meta else -1
    fresh = [b for b in _batches(spark, changelog) if b > done]
    if not fresh:
        return meta["through"] if meta else None
    new = _read_batches(spark, changelog, fresh).withColumn("window_date", window_date())
    touched = sorted(str(r[0]) for r in new.select("window_date").distinct().collect())
    held = dict(meta["dates"]) if meta else {}
    old = _read_dates(spark, base, {d: held[d] for d in touched if d in held})
    version = new_version(spark, base)
    folded = _latest(new.drop("window_date").unionByName(old)).withColumn("window_date", window_date())
    folded.repartition("window_date", F.pmod(F.xxhash64(*_KEY), F.lit(FOLD_SALTS))).write.partitionBy(
        "window_date").parquet(f"{base}/{version}/data")
    dates = held | {d: version for d in touched}
    publish_version(spark, base, version, {
        "through": fresh[-1], "dates": dates,
        "before": {"through": done, "dates": held}})
    _clean_fold(spark, changelog, base, meta, dates, held)
    return fresh[-1]


FOLD_SALTS = 8      # tasks that may share one date's rows in a fold


def _read_dates(spark: SparkSession, base: str, dates: dict[str, str]) -> DataFrame:
    if not dates:
        return spark.createDataFrame([], _CHANGELOG_SCHEMA)
    return spark.read.schema(_CHANGELOG_SCHEMA).parquet(
        *[f"{base}/{v}/data/window_date={d}" for d, v in sorted(dates.items())]).select(*_FOLDED_COLUMNS)


def _clean_fold(spark: SparkSession, changelog: str, base: str, meta: dict | None,
                dates: dict[str, str], held: dict[str, str]) -> None:
    """Delete what only versions before the last two used."""
    if meta is None:
        return
    for b in _batches(spark, changelog):
        if b <= meta["through"]:
            delete_path(spark, f"{changelog.rstrip('/')}/batch_id={b}")
    for d, v in meta["before"]["dates"].items():
        if v not in (dates.get(d), held.get(d)):
            delete_path(spark, f"{base}/{v}/data/window_date={d}")
    used = {*dates.values(), *held.values(), meta["version"]}
    for n in versions(spark, base)[:-2]:
        if n not in used:
            delete_path(spark, f"{base}/{n}")


def current_features(spark: SparkSession, changelog: str, table: str) -> DataFrame:
    """Latest value per (window, service) = folded dates + the changelog
    batches written after the last fold."""
    base = table.rstrip("/")
    meta = current_version(spark, base)
    if meta is None:
        return latest_features(spark, changelog)
    recent = [b for b in _batches(spark, changelog) if b > meta["through"]]
    rows = _read_dates(spark, base, meta["dates"]).unionByName(
        _read_batches(spark, changelog, recent))
    return _latest(rows).select(*[f.name for f in FEATURE_SCHEMA.fields])


def start_feature_table(features_stream: DataFrame, path: str, checkpoint: str,
                        trigger: dict | None = None,
                        query_name: str | None = None,
                        state_partitions: int | None = None) -> StreamingQuery:
    """Append mode: a window is written once, after the watermark closes it
    (exactly once through the file sink's commit log)."""
    w = (_writer(features_stream, "append", trigger or DEFAULT_TRIGGER, checkpoint,
                 query_name)
         .format("parquet").option("path", path))
    return _start(w, features_stream.sparkSession, state_partitions)


# ------------------------------------------------------------------ alerts ---

def alert_batch_handler(store_path: str,
                        publish: Callable[[DataFrame], None] | None = None,
                        withdraw: bool = False) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: gate and insert. The stream emits one row per window
    and service, so alerts are unique; the insert persists the gated rows (once)
    and ends at once when there are none.

    With ``withdraw`` the batch holds every window that changed, gated or not
    (it is persisted: both steps read it); alerts that such a window raised
    before and does not raise now are withdrawn."""
    def handle(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if not withdraw:
            insert_alerts(spark, alert_records(batch_df), store_path, publish, unique=True)
            return
        batch = batch_df.persist()
        try:
            withdraw_alerts(spark, batch, alert_records(batch), store_path)
            insert_alerts(spark, alert_records(batch), store_path, publish, unique=True)
        finally:
            batch.unpersist()
    return handle


def start_detection(logs_stream: DataFrame, bundle: ModelBundle, store_path: str,
                    checkpoint: str, trigger: dict | None = None,
                    publish: Callable[[DataFrame], None] | None = None,
                    output_mode: str = "update", watermark: str | None = None,
                    query_name: str | None = None,
                    window: str | None = None,
                    state_partitions: int | None = None,
                    withdraw: bool = False) -> StreamingQuery:
    """The detection job: logs -> features -> score -> alerts -> store.

    ``withdraw`` takes back an alert whose window, with more logs, does not pass
    its gate any more; it reads the windows below the gates too.

    Features use the model's own window width. ``window`` scores on another
    width (the original trained on 5-minute and scored 15-minute windows);
    it must be asked for explicitly."""
    feats = stream_features(logs_stream, window or bundle.window, watermark)
    scored = score(feats if withdraw else pre_gate(feats), bundle)
    w = (_writer(scored, output_mode, trigger or DEFAULT_TRIGGER, checkpoint, query_name)
         .foreachBatch(alert_batch_handler(store_path, publish, withdraw)))
    return _start(w, logs_stream.sparkSession, state_partitions)


def run_until_idle(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Block until the query ends (``availableNow`` ends by itself); surface
    its failure instead of swallowing it."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
