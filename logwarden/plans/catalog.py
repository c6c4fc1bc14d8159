"""Named queries over a test-data folder: ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole ``events`` table (as logs) and lets its work grow
with it. Queries that exercise a sink write to a fresh folder below the shared
checkpoint folder and return what they read back.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import error_marker, is_error, message_length, seconds
from ..operators import alerts as A
from ..operators.incremental import refit, refit_scaler, refresh_partials
from ..operators.features import prepare_features, window_features
from ..operators.model import (ensure_model, load_bundle, save_bundle, scaler_table, train,
                               train_scaler)
from ..operators.profile import (check_mix_rules, observed_mix, service_gaps,
                                 service_level_mix)
from ..operators.scoring import predict, scaled_vector_columns, score
from ..schemas import RECORD_SCHEMA, VECTOR_COLUMNS
from ..session import move_path, pin_utc, scratch_path
from ..sinks.alert_counts import alert_dates, refresh_counts, stored_severity_counts
from ..sinks.alert_store import compact_alerts, insert_alerts, read_alerts
from ..sinks.snapshot import read_snapshot, snapshot_logs
from ..sinks.topic import alerts_to_records, decode_alert_records, publish_records
from ..sources.codec import classify_records, decode_logs, encode_logs
from ..sources.fixtures import load_logs
from ..sources.topic import read_topic, read_topic_stream
from ..sources.variant import decode_variant, extra_text, failure_counts
from ..streaming.detector import (current_features, fold_changelog,
                                  latest_features, logs_from_event_files, logs_from_records,
                                  run_until_idle, start_detection,
                                  start_feature_changelog, start_feature_table,
                                  stream_features)
from ..streaming.progress import ProgressRecorder, read_progress, run_until_caught_up, trigger_gaps
from ..streaming.watch import (accounted_rows, open_windows, silent_services, start_late_accounting,
                              start_session_table, SESSION_SCHEMA)
from .fixed_model import FIXED_WINDOW, fixed_bundle

Query = Callable[[SparkSession, str], DataFrame]

JUNK_EVERY = 97        # malformed_split: every 97th record's value is junk
NULL_EVERY = 89        # ... and every 89th record has no value at all


def _features(spark: SparkSession, sf_dir: str, window: str) -> DataFrame:
    return window_features(load_logs(spark, sf_dir), window)


# ------------------------------------------------------------ decoding -----

def logs_scan(spark, sf_dir):
    return load_logs(spark, sf_dir)


def log_level_flags(spark, sf_dir):
    return load_logs(spark, sf_dir).select(
        "relatedObjectId", "level",
        is_error("level").alias("is_error"),
        error_marker("level").alias("error_marker"),
        message_length("message").alias("message_length"))


def log_record_roundtrip(spark, sf_dir):
    """logs -> records (key, JSON value) -> topic files -> scan -> decode."""
    path = scratch_path(spark, "logs-topic")
    publish_records(encode_logs(load_logs(spark, sf_dir)), path=path)
    records = read_topic(spark, path=path)
    return decode_logs(records.withColumn("key", F.col("key").cast("string")),
                       keep=("key",))


def _event_number():
    return F.regexp_replace("relatedObjectId", "^EVT-", "").cast("long")


LIST_EVERY, UNTIMED_EVERY, BAD_TIME_EVERY, NUMBER_EVERY, REGION_EVERY = 83, 79, 73, 71, 7


def _mixed_records(spark, sf_dir) -> DataFrame:
    """All logs as records of many producers: some send junk, nothing, a list,
    no time stamp or a bad one, a number for a level; some a region besides."""
    logs = load_logs(spark, sf_dir)
    n = F.col("n")
    stamp = F.date_format("timestamp", C.WIRE_TIME_FORMAT)
    members = F.to_json(F.struct(
        F.when(n % BAD_TIME_EVERY == 0, F.concat(F.lit("at "), stamp))
         .when(n % UNTIMED_EVERY != 0, stamp).alias("timestamp"),
        "message", "relatedObjectId", "serviceName",
        F.when(n % NUMBER_EVERY != 0, F.col("level")).alias("level")))
    more = F.concat(
        F.when(n % NUMBER_EVERY == 0, F.format_string(',"level":%d', n)).otherwise(""),
        F.when(n % REGION_EVERY == 0, F.format_string(',"region":{"id":%d}', n)).otherwise(""))
    whole = F.concat(F.expr("substring(_members, 1, length(_members) - 1)"), more, F.lit("}"))
    return (logs.withColumn("n", _event_number()).withColumn("_members", members)
            .select(F.col("relatedObjectId").alias("key"),
                    F.when(n % JUNK_EVERY == 0, F.concat(F.lit("not json: "), F.col("relatedObjectId")))
                    .when(n % NULL_EVERY == 0, F.lit(None).cast("string"))
                    .when(n % LIST_EVERY == 0, F.format_string("[%d]", n))
                    .otherwise(whole).cast("binary").alias("value")))


def variant_decode(spark, sf_dir):
    """Every record with the reason and field of what does not fit, and the
    unknown field that some carry."""
    return decode_variant(_mixed_records(spark, sf_dir)).select(
        "key", "reason", "field", "timestamp", "level", "serviceName",
        F.get(F.map_keys("extra"), F.lit(0)).alias("extra_name"), extra_text("region").alias("region"))


def variant_failures(spark, sf_dir):
    """Rows by reason and field."""
    return failure_counts(decode_variant(_mixed_records(spark, sf_dir)))


def malformed_split(spark, sf_dir):
    """Records with injected junk and null values, classified in one pass."""
    records = encode_logs(load_logs(spark, sf_dir), topic=None)
    n = F.regexp_replace(F.col("key").cast("string"), "^EVT-", "").cast("long")
    junk = F.concat(F.lit("not json: "), F.col("key").cast("string")).cast("binary")
    damaged = records.select(
        "key",
        F.when(n % JUNK_EVERY == 0, junk)
         .when(n % NULL_EVERY == 0, F.lit(None).cast("binary"))
         .otherwise(F.col("value")).alias("value"))
    return classify_records(damaged).select(
        F.col("key").cast("string").alias("key"), "reason", "timestamp", "level",
        "serviceName")


# ------------------------------------------------------------ features -----

def window_features_5m(spark, sf_dir):
    """The training-side feature table."""
    return prepare_features(load_logs(spark, sf_dir), C.TRAINING_WINDOW)


def window_features_15m(spark, sf_dir):
    return _features(spark, sf_dir, "15 minutes")


def window_features_6h(spark, sf_dir):
    return _features(spark, sf_dir, "6 hours")


def window_features_1d(spark, sf_dir):
    return _features(spark, sf_dir, "1 day")


# --------------------------------------------------------------- model -----

def _round6(c):
    return F.round(c, 6)


def scaler_stats(spark, sf_dir):
    bundle = train_scaler(_features(spark, sf_dir, FIXED_WINDOW), FIXED_WINDOW)
    return scaler_table(spark, bundle).select(
        "feature", "position", _round6(F.col("mean")).alias("mean"),
        _round6(F.col("std")).alias("std"))


def _stored(spark, df: DataFrame, name: str) -> DataFrame:
    """Rows that several steps use, made once."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scaled_features(spark, sf_dir):
    feats = _stored(spark, _features(spark, sf_dir, FIXED_WINDOW), "features")
    z = scaled_vector_columns(feats, train_scaler(feats, FIXED_WINDOW))
    return z.select("window_start", "serviceName",
                    *[_round6(F.col("z_" + n)).alias("z_" + n) for n in VECTOR_COLUMNS])


def centroid_score(spark, sf_dir):
    scored = score(_features(spark, sf_dir, FIXED_WINDOW), fixed_bundle())
    return scored.select("window_start", "window_end", "serviceName", "total_logs",
                         "error_count", "error_rate", "prediction")


def kmeans_profile(spark, sf_dir):
    """Fit k-means on the data, then size and mean rates per cluster."""
    feats = _stored(spark, _features(spark, sf_dir, FIXED_WINDOW), "features")
    bundle = train(feats, FIXED_WINDOW)
    return (predict(feats, bundle).groupBy("prediction")
            .agg(F.count(F.lit(1)).alias("size"),
                 F.round(F.avg("error_rate"), 6).alias("mean_error_rate"),
                 F.round(F.avg("total_logs"), 6).alias("mean_total_logs"))
            .withColumnRenamed("prediction", "cluster"))


def _squared_distance(center: list[float]):
    """Squared distance of a row's z columns to a centre."""
    terms = [(F.col("z_" + n) - F.lit(float(c))) * (F.col("z_" + n) - F.lit(float(c)))
             for n, c in zip(VECTOR_COLUMNS, center)]
    return sum(terms[1:], terms[0])


def kmeans_check(spark, sf_dir):
    """What any right fit must satisfy, in one row: all feature rows assigned,
    k clusters, no row at another than its nearest centre, and a total cost not
    above that of one cluster (the rows' mean, which scaling puts at zero). The
    model is trained, saved, loaded and applied."""
    feats = _stored(spark, _features(spark, sf_dir, FIXED_WINDOW), "features")
    path = scratch_path(spark, "model")
    save_bundle(spark, train(feats, FIXED_WINDOW), path)
    bundle = load_bundle(spark, path, FIXED_WINDOW)
    z = scaled_vector_columns(predict(feats, bundle), bundle)
    distance = F.array(*[_squared_distance(c) for c in bundle.centers])
    rows = z.withColumn("d", distance).select(
        "prediction", F.array_min("d").alias("least"), F.get("d", F.col("prediction")).alias("own"),
        _squared_distance([0.0] * len(VECTOR_COLUMNS)).alias("alone"))
    return rows.agg(
        F.count("prediction").alias("size_sum"),
        F.count_distinct("prediction").alias("clusters"),
        F.count_if(F.col("own") > F.col("least") + 1e-9).alias("not_nearest"),
        (F.sum("own") <= F.sum("alone") + 1e-6).alias("cost_not_above_one_cluster"))


def _halves(spark, feats: DataFrame):
    """The feature table as it stood halfway, and in full."""
    lo, hi = feats.agg(F.min("window_start"), F.max("window_start")).first()
    middle = lo + (hi - lo) / 2 if lo is not None else None
    return [feats.filter(F.col("window_start") <= F.lit(middle)), feats]


def scaler_stats_by_date(spark, sf_dir):
    """Scaler statistics merged from per-date moments; the second half of the
    dates is added to the stored first half."""
    feats, path = _stored(spark, _features(spark, sf_dir, FIXED_WINDOW), "features"), scratch_path(spark, "partials")
    for part in _halves(spark, feats):
        refresh_partials(spark, part, path)
    return scaler_table(spark, refit_scaler(spark, path, FIXED_WINDOW)).select(
        "feature", "position", _round6(F.col("mean")).alias("mean"),
        _round6(F.col("std")).alias("std"))


def kmeans_coreset_check(spark, sf_dir):
    """The model from per-date cells against one fitted on all rows: every row
    scored, and a cost within 1 % (both costs over all rows, same scaler)."""
    feats, path = _stored(spark, _features(spark, sf_dir, FIXED_WINDOW), "features"), scratch_path(spark, "partials")
    for part in _halves(spark, feats):
        refresh_partials(spark, part, path)
    coreset, full = refit(spark, path, FIXED_WINDOW), train(feats, FIXED_WINDOW)
    z = scaled_vector_columns(feats, full)

    def cost(bundle):
        return F.sum(F.array_min(F.array(*[_squared_distance(c) for c in bundle.centers])))

    return z.agg(F.count(F.lit(1)).alias("rows"), F.lit(coreset.k).cast("long").alias("clusters"),
                 (cost(coreset) <= cost(full) * 1.01 + 1e-9).alias("cost_within_one_percent"))


def model_reuse_alerts(spark, sf_dir):
    """The fixed model saved, found again instead of trained, loaded, and used
    for scoring and alerts."""
    path = scratch_path(spark, "model")
    save_bundle(spark, fixed_bundle(), path)

    def train_logs():
        raise AssertionError("a stored model must be reused")

    bundle = ensure_model(spark, path, train_logs, "360 minutes")
    return _checked_alert_columns(A.alert_records(
        score(_features(spark, sf_dir, bundle.window), bundle)))


# -------------------------------------------------------------- alerts -----

def _scored_fixed(spark, sf_dir):
    return score(_features(spark, sf_dir, FIXED_WINDOW), fixed_bundle())


def _gate_columns(df):
    return df.select("window_start", "serviceName", "total_logs", "error_rate", "prediction")


def alerts_medium(spark, sf_dir):
    return _gate_columns(A.medium_risk(_scored_fixed(spark, sf_dir)))


def alerts_high(spark, sf_dir):
    return _gate_columns(A.high_risk(_scored_fixed(spark, sf_dir)))


def _checked_alert_columns(alerts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Alert rows minus the insert time, metadata flattened."""
    return alerts.select(
        *keep, "id", "type", "severity", "source", "description",
        F.col("metadata.serviceName").alias("meta_service_name"),
        F.col("metadata.errorRate").alias("meta_error_rate"),
        "window_start", "window_end")


def alert_records(spark, sf_dir):
    return _checked_alert_columns(A.alert_records(_scored_fixed(spark, sf_dir)))


def _filled_store(spark, sf_dir) -> str:
    path = scratch_path(spark, "alert-store")
    alerts = _stored(spark, A.alert_records(_scored_fixed(spark, sf_dir)), "alerts")
    insert_alerts(spark, alerts, path)
    insert_alerts(spark, alerts, path)     # a resend adds nothing
    return path


def alert_listing(spark, sf_dir):
    """Listing of what was stored; the time column shows the window start
    (the insert time is not reproducible)."""
    return A.alert_listing(read_alerts(spark, _filled_store(spark, sf_dir)),
                           time_col="window_start")


def severity_counts(spark, sf_dir):
    return A.severity_counts(read_alerts(spark, _filled_store(spark, sf_dir)))


def alert_insert_times(spark, sf_dir):
    """One row a severity: whether a batch of none of its alerts stores nothing,
    the alerts stored, and whether every insert time lies between the start and
    the end of its insert (a resend leaves it as it was)."""
    alerts = _stored(spark, A.alert_rows(A.gated(_scored_fixed(spark, sf_dir)), F.lit(None).cast("timestamp")),
                     "alerts")
    rows = []
    for sev in (C.SEVERITY_HIGH, C.SEVERITY_MEDIUM, C.SEVERITY_LOW):
        store = scratch_path(spark, "alert-store")
        some = alerts.filter(F.col("severity") == sev).withColumn("timestamp", F.current_timestamp())
        insert_alerts(spark, some.filter(F.lit(False)), store)
        nothing = read_alerts(spark, store).isEmpty()
        began, _ = _now(spark), insert_alerts(spark, some, store)
        ended, _ = _now(spark), insert_alerts(spark, some, store)
        at = F.col("timestamp")
        rows.append(read_alerts(spark, store).agg(
            F.lit(sev).alias("severity"), F.lit(nothing).alias("empty_batch_stores_nothing"),
            F.count(F.lit(1)).alias("alerts"),
            F.coalesce(F.bool_and(at.isNotNull() & at.between(F.lit(began), F.lit(ended))),
                       F.lit(True)).alias("inserted_in_time")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _now(spark):
    return spark.range(1).select(F.current_timestamp()).first()[0]


def severity_counts_by_date(spark, sf_dir):
    """Counts kept by date over two inserts and a compaction; each refresh reads
    the dates its insert touched."""
    store, counts = scratch_path(spark, "alert-store"), scratch_path(spark, "alert-counts")
    alerts = _stored(spark, A.alert_records(_scored_fixed(spark, sf_dir)), "alerts")
    for sev in (C.SEVERITY_HIGH, C.SEVERITY_MEDIUM):
        some = alerts.filter(F.col("severity") == sev)
        insert_alerts(spark, some, store)
        refresh_counts(spark, store, counts, alert_dates(some))
    compact_alerts(spark, store, "9999-12-31")
    return stored_severity_counts(spark, counts)


def alert_store_compacted(spark, sf_dir):
    """Alerts stored by severity in two appends, then every date compacted;
    the store must still hold each alert exactly once."""
    path = scratch_path(spark, "alert-store")
    alerts = _stored(spark, A.alert_records(_scored_fixed(spark, sf_dir)), "alerts")
    for sev in (C.SEVERITY_HIGH, C.SEVERITY_MEDIUM):
        insert_alerts(spark, alerts.filter(F.col("severity") == sev), path)
    compact_alerts(spark, path, "9999-12-31")
    insert_alerts(spark, alerts, path)         # a resend after compaction adds nothing
    return _checked_alert_columns(read_alerts(spark, path))


def alert_topic_rows(spark, sf_dir):
    path = scratch_path(spark, "alerts-topic")
    alerts = A.alert_records(_scored_fixed(spark, sf_dir))
    publish_records(alerts_to_records(alerts), path=path)
    decoded = decode_alert_records(read_topic(spark, path=path))
    return _checked_alert_columns(decoded, keep=("key",))


# ----------------------------------------------------------- streaming -----

def _event_glob(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events*.parquet"


def _state_parts(spark) -> int:
    """State partitions for the test-data streams: the session's parallelism
    (the test tables are small; a cluster job would size this to its state)."""
    return max(1, spark.sparkContext.defaultParallelism)


def stream_features_update(spark, sf_dir):
    pin_utc(spark)
    out, ckpt = scratch_path(spark, "feat-changelog"), scratch_path(spark, "ckpt")
    feats = stream_features(logs_from_event_files(spark, _event_glob(sf_dir)), FIXED_WINDOW)
    run_until_idle(start_feature_changelog(feats, out, ckpt, {"availableNow": True},
                                           state_partitions=_state_parts(spark)))
    return latest_features(spark, out)


def stream_features_append(spark, sf_dir):
    pin_utc(spark)
    out, ckpt = scratch_path(spark, "feat-table"), scratch_path(spark, "ckpt")
    feats = stream_features(logs_from_event_files(spark, _event_glob(sf_dir)), FIXED_WINDOW)
    run_until_idle(start_feature_table(feats, out, ckpt, {"availableNow": True},
                                       state_partitions=_state_parts(spark)))
    return spark.read.parquet(out)


def stream_alerts(spark, sf_dir):
    """The detection stream run twice (fresh checkpoints) into one store."""
    pin_utc(spark)
    store = scratch_path(spark, "alert-store")
    for _ in range(2):
        logs = logs_from_event_files(spark, _event_glob(sf_dir))
        run_until_idle(start_detection(logs, fixed_bundle(), store,
                                       scratch_path(spark, "ckpt"), {"availableNow": True},
                                       state_partitions=_state_parts(spark)))
    return _checked_alert_columns(read_alerts(spark, store))


def stream_alerts_append(spark, sf_dir):
    """Detection in append mode: alerts only for windows the watermark has
    closed, i.e. on final counts."""
    pin_utc(spark)
    store = scratch_path(spark, "alert-store")
    logs = logs_from_event_files(spark, _event_glob(sf_dir))
    run_until_idle(start_detection(logs, fixed_bundle(), store, scratch_path(spark, "ckpt"),
                                   {"availableNow": True}, output_mode="append",
                                   state_partitions=_state_parts(spark)))
    return _checked_alert_columns(read_alerts(spark, store))


REPLAY_SLICES = 4


def _arriving_slices(spark, logs: DataFrame, which, n: int):
    """The log topic arriving in ``n`` slices (``which``: slice of a log), one
    after the other: a slice's records are written aside and moved into the
    topic folder whole. A write holds one slice, so its tasks need not sort
    their rows by slice. Yields (slice number, record stream) after each; a
    slice without rows adds no file."""
    staged, topic = scratch_path(spark, "logs-staged"), scratch_path(spark, "logs-topic-replay")
    for i in range(n):
        part = f"{staged}/slice{i}"
        encode_logs(logs.filter(which.cast("int") == i)).write.parquet(part)
        if not spark.read.schema(RECORD_SCHEMA).parquet(part).isEmpty():
            move_path(spark, part, f"{topic}/slice{i}")
        yield i, read_topic_stream(spark, path=f"{topic}/*", fmt="parquet", schema=RECORD_SCHEMA)


def stream_topic_replay(spark, sf_dir):
    """The log topic arriving in time order, in REPLAY_SLICES slices.

    Each slice is appended to the topic folder as JSON records, then the
    feature stream resumes from its checkpoint (availableNow) and takes what
    is new: decoding in a stream, state carried across batches and restarts,
    windows spanning slices re-emitted. The changelog is folded after each
    slice but the last, so the answer combines folded rows with the final
    slice's batches. Every record lands in exactly one slice.
    """
    logs = load_logs(spark, sf_dir)
    which = _time_slices(logs, REPLAY_SLICES)
    out, ckpt = scratch_path(spark, "feat-changelog"), scratch_path(spark, "ckpt")
    folded = scratch_path(spark, "feat-folded")
    for i, records in _arriving_slices(spark, logs, which, REPLAY_SLICES):
        feats = stream_features(logs_from_records(records), FIXED_WINDOW)
        run_until_idle(start_feature_changelog(feats, out, ckpt, {"availableNow": True},
                                               state_partitions=_state_parts(spark)))
        if i < REPLAY_SLICES - 1:
            fold_changelog(spark, out, folded)
    return current_features(spark, out, folded)


LATE_EVERY = 10


def stream_late_rows(spark, sf_dir):
    """Every LATE_EVERY-th event arrives after all others: it only counts where
    the watermark (newest time of the others minus the width) has not closed
    its window."""
    pin_utc(spark)
    logs = load_logs(spark, sf_dir)
    number = F.regexp_replace("relatedObjectId", "^EVT-", "").cast("long")
    out, ckpt = scratch_path(spark, "feat-changelog"), scratch_path(spark, "ckpt")
    late = F.when(number % LATE_EVERY == 0, 1).otherwise(0)
    for _, records in _arriving_slices(spark, logs, late, 2):
        feats = stream_features(logs_from_records(records), FIXED_WINDOW)
        run_until_idle(start_feature_changelog(feats, out, ckpt, {"availableNow": True},
                                               state_partitions=_state_parts(spark)))
    return latest_features(spark, out)


def _window_quarter():
    """Which part of its window a log falls into."""
    width = seconds(FIXED_WINDOW) * 1_000_000
    return F.coalesce(F.floor(F.pmod(F.unix_micros("timestamp"), F.lit(width))
                              / F.lit(width // REPLAY_SLICES)), F.lit(0))


def stream_alerts_replay(spark, sf_dir):
    """Detection over REPLAY_SLICES time slices of every window: first the
    first quarter of all windows arrives, then the second, and so on, so each
    window is emitted again with other counts. The store must hold the last
    gated value of each alert."""
    pin_utc(spark)
    logs = load_logs(spark, sf_dir)
    store, ckpt = scratch_path(spark, "alert-store"), scratch_path(spark, "ckpt")
    for _, records in _arriving_slices(spark, logs, _window_quarter(), REPLAY_SLICES):
        run_until_idle(start_detection(logs_from_records(records), fixed_bundle(), store, ckpt,
                                       {"availableNow": True}, watermark="36500 days",
                                       state_partitions=_state_parts(spark)))
    return _checked_alert_columns(read_alerts(spark, store))


def stream_alerts_withdrawn(spark, sf_dir):
    """The slices of ``stream_alerts_replay`` with withdrawal: an alert raised on
    partial counts goes when its window no longer passes, so the store ends with
    the alerts of the final counts."""
    pin_utc(spark)
    logs = load_logs(spark, sf_dir)
    store, ckpt = scratch_path(spark, "alert-store"), scratch_path(spark, "ckpt")
    for _, records in _arriving_slices(spark, logs, _window_quarter(), REPLAY_SLICES):
        run_until_idle(start_detection(logs_from_records(records), fixed_bundle(), store, ckpt,
                                       {"availableNow": True}, watermark="36500 days", withdraw=True,
                                       state_partitions=_state_parts(spark)))
    return _checked_alert_columns(read_alerts(spark, store))


def _time_slices(logs: DataFrame, n: int):
    """The ``n`` equal time slices of the logs, as a slice number."""
    micros = F.unix_micros(F.col("timestamp"))
    lo, hi = logs.agg(F.min(micros), F.max(micros)).first()
    step = ((hi - lo) // n + 1) if lo is not None else 1
    return F.coalesce(F.floor((micros - F.lit(lo or 0)) / F.lit(step)), F.lit(0))


SILENT_AFTER = "10 minutes"


def stream_silent_services(spark, sf_dir):
    """Silences of each service, over logs that arrive in time slices."""
    pin_utc(spark)
    logs = load_logs(spark, sf_dir)
    out, ckpt = scratch_path(spark, "sessions"), scratch_path(spark, "ckpt")
    for _, records in _arriving_slices(spark, logs, _time_slices(logs, REPLAY_SLICES), REPLAY_SLICES):
        run_until_idle(start_session_table(logs_from_records(records), SILENT_AFTER, out, ckpt,
                                           trigger={"availableNow": True},
                                           state_partitions=_state_parts(spark)))
    return silent_services(spark.read.schema(SESSION_SCHEMA).parquet(out))


def stream_late_accounting(spark, sf_dir):
    """Rows by service and reason when every LATE_EVERY-th event arrives after
    all others (as in ``stream_late_rows``): on time and late add up to all."""
    pin_utc(spark)
    logs = load_logs(spark, sf_dir)
    number = F.regexp_replace("relatedObjectId", "^EVT-", "").cast("long")
    out, ckpt = scratch_path(spark, "accounted"), scratch_path(spark, "ckpt")
    late = F.when(number % LATE_EVERY == 0, 1).otherwise(0)
    for _, records in _arriving_slices(spark, logs, late, 2):
        run_until_idle(start_late_accounting(logs_from_records(records), out, FIXED_WINDOW, ckpt,
                                             trigger={"availableNow": True}))
    return accounted_rows(spark, out).groupBy("serviceName", "batch_id", "reason").agg(
        F.count(F.lit(1)).alias("total_logs"), F.min("timestamp").alias("first_log"),
        F.max("timestamp").alias("last_log"))


def stream_state_audit(spark, sf_dir):
    """The windows that the feature stream holds open after each time slice."""
    pin_utc(spark)
    logs = load_logs(spark, sf_dir)
    out, ckpt, audits = (scratch_path(spark, n) for n in ("feat-changelog", "ckpt", "audits"))
    for i, records in _arriving_slices(spark, logs, _time_slices(logs, REPLAY_SLICES), REPLAY_SLICES):
        feats = stream_features(logs_from_records(records), FIXED_WINDOW)
        run_until_idle(start_feature_changelog(feats, out, ckpt, {"availableNow": True},
                                               state_partitions=_state_parts(spark)))
        open_windows(spark, ckpt).withColumn("slice", F.lit(i)).write.mode("append").parquet(audits)
    return spark.read.parquet(audits)


ADMISSION_TRIGGER = 1      # seconds


def _one_file_a_slice(spark, logs: DataFrame, which, n: int) -> str:
    """The log topic as one file a slice (a slice is as many rows as a producer
    rolls into a file). A slice's number is the number of the task that writes
    it: no two slices meet in a task, and as ``slice`` is a column of the file
    and no folder, rows pass through unsorted, a row group at a time."""
    path = scratch_path(spark, "logs-topic-files")
    encode_logs(logs.withColumn("slice", which.cast("int")), keep=("slice",)).repartitionById(
        n, "slice").write.parquet(path)
    return path


def stream_admission(spark, sf_dir):
    """Rows and batches of each file of a topic, read one file a trigger on a
    processing-time trigger; and whether the triggers kept their distance. The
    rows come from the progress that the listener recorded, the slice of a batch
    from what the batch wrote."""
    pin_utc(spark)
    logs = load_logs(spark, sf_dir)
    topic = _one_file_a_slice(spark, logs, _time_slices(logs, REPLAY_SLICES), REPLAY_SLICES)
    out, ckpt, progress = (scratch_path(spark, n) for n in ("admitted", "ckpt", "progress"))
    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField("slice", T.IntegerType())])
    records = read_topic_stream(spark, path=topic, schema=schema, max_files_per_trigger=1)

    def admit(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))
         .withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out))

    with ProgressRecorder(spark, progress) as recorder:
        query = (records.writeStream.foreachBatch(admit).option("checkpointLocation", ckpt)
                 .trigger(processingTime=f"{ADMISSION_TRIGGER} seconds").start())
        recorder.wait(run_until_caught_up(query))
    told = read_progress(spark, progress)
    # Triggers start in intervals of their own: n of them span more than n - 2.
    kept = trigger_gaps(told).select(
        "query_id", (F.unix_millis("last_start") - F.unix_millis("first_start")
                     > (F.col("batches") - 2) * ADMISSION_TRIGGER * 1000 - 100).alias("triggers_apart"))
    fed = told.join(kept, "query_id").join(spark.read.parquet(out), "batch_id")
    return fed.groupBy("slice").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("rows").alias("total_logs"), F.bool_and("triggers_apart").alias("triggers_apart"))


# --------------------------------------------------------------- sinks -----

def training_snapshot(spark, sf_dir):
    path = scratch_path(spark, "training-logs")
    snapshot_logs(load_logs(spark, sf_dir), path=path)
    return read_snapshot(spark, path=path)


# ------------------------------------------------------------- profile -----

def service_level_mix_q(spark, sf_dir):
    return service_level_mix(load_logs(spark, sf_dir))


def service_gaps_q(spark, sf_dir):
    return service_gaps(load_logs(spark, sf_dir))


def mix_rule_check(spark, sf_dir):
    return check_mix_rules(observed_mix(load_logs(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "logs_scan": logs_scan,
    "log_level_flags": log_level_flags,
    "log_record_roundtrip": log_record_roundtrip,
    "malformed_split": malformed_split,
    "variant_decode": variant_decode,
    "variant_failures": variant_failures,
    "window_features_5m": window_features_5m,
    "window_features_15m": window_features_15m,
    "window_features_6h": window_features_6h,
    "window_features_1d": window_features_1d,
    "scaler_stats": scaler_stats,
    "scaled_features": scaled_features,
    "centroid_score": centroid_score,
    "kmeans_profile": kmeans_profile,
    "kmeans_check": kmeans_check,
    "scaler_stats_by_date": scaler_stats_by_date,
    "kmeans_coreset_check": kmeans_coreset_check,
    "model_reuse_alerts": model_reuse_alerts,
    "alerts_medium": alerts_medium,
    "alerts_high": alerts_high,
    "alert_records": alert_records,
    "alert_listing": alert_listing,
    "severity_counts": severity_counts,
    "alert_insert_times": alert_insert_times,
    "severity_counts_by_date": severity_counts_by_date,
    "alert_store_compacted": alert_store_compacted,
    "alert_topic_rows": alert_topic_rows,
    "stream_features_update": stream_features_update,
    "stream_features_append": stream_features_append,
    "stream_alerts": stream_alerts,
    "stream_alerts_append": stream_alerts_append,
    "stream_topic_replay": stream_topic_replay,
    "stream_late_rows": stream_late_rows,
    "stream_alerts_replay": stream_alerts_replay,
    "stream_alerts_withdrawn": stream_alerts_withdrawn,
    "stream_silent_services": stream_silent_services,
    "stream_late_accounting": stream_late_accounting,
    "stream_state_audit": stream_state_audit,
    "stream_admission": stream_admission,
    "training_snapshot": training_snapshot,
    "service_level_mix": service_level_mix_q,
    "service_gaps": service_gaps_q,
    "mix_rule_check": mix_rule_check,
}
