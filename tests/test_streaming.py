"""Structured Streaming: watermark, late rows, update/append, restart, delivery."""

import os

import pytest

from conftest import SF001, make_logs
from logwarden.operators.features import window_features
from logwarden.operators.model import ModelBundle
from logwarden.sinks.alert_store import read_alerts
from logwarden.sources.codec import encode_logs
from logwarden.sources.fixtures import load_logs
from logwarden.sources.topic import read_topic_stream
from logwarden.streaming import (alert_batch_handler, latest_features, logs_from_event_files,
                                 logs_from_records, run_until_idle, start_detection,
                                 start_feature_changelog, start_feature_table, stream_features)

W = "15 minutes"
REC_SCHEMA = "key binary, value binary, topic string"


def _write_batch(spark, folder, name, rows):
    encode_logs(make_logs(spark, rows)).coalesce(1).write.parquet(os.path.join(folder, name))


def _replay_files(spark, base):
    """F7 replay, one file per micro-batch.

    Spark filters late rows against the watermark of the *previous* batch
    (eviction uses the current one), so the late row comes one batch after
    the watermark (00:40 - 15 min = 00:25) has passed its window."""
    inp = os.path.join(base, "in")
    _write_batch(spark, inp, "b0", [("2024-01-01T00:01:00", "ERROR", "m", "A-1", "a"),
                                    ("2024-01-01T00:05:00", "INFO", "m", "A-2", "a")])
    _write_batch(spark, inp, "b1", [("2024-01-01T00:20:00", "INFO", "m", "A-3", "a"),
                                    ("2024-01-01T00:40:00", "ERROR", "m", "A-4", "a")])
    _write_batch(spark, inp, "b2", [("2024-01-01T00:41:00", "INFO", "m", "A-5", "a")])
    _write_batch(spark, inp, "b3", [("2024-01-01T00:03:00", "ERROR", "late", "A-6", "a"),
                                    ("2024-01-01T00:42:00", "INFO", "m", "A-7", "a")])
    return os.path.join(inp, "*")


def _stream(spark, glob):
    return logs_from_records(read_topic_stream(spark, path=glob, schema=REC_SCHEMA,
                                               max_files_per_trigger=1))


def test_update_mode_watermark_drops_late_rows_and_evicts_state(spark, tmp_dir):
    glob = _replay_files(spark, tmp_dir)
    out = os.path.join(tmp_dir, "changelog")
    q = start_feature_changelog(stream_features(_stream(spark, glob), W), out,
                                os.path.join(tmp_dir, "ckpt"), {"availableNow": True})
    run_until_idle(q)
    log = spark.read.parquet(out)
    per_batch = {}
    for r in log.collect():
        per_batch.setdefault(r["batch_id"], []).append(
            (r["window_start"].strftime("%H:%M"), r["total_logs"]))
    # each changed window once per batch; the late row never reaches 00:00
    assert sorted(per_batch[0]) == [("00:00", 2)]
    assert sorted(per_batch[1]) == [("00:15", 1), ("00:30", 1)]
    assert sorted(per_batch[2]) == [("00:30", 2)]
    assert sorted(per_batch[3]) == [("00:30", 3)]
    ops = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert sum(o["numRowsDroppedByWatermark"] for o in ops) == 1
    assert sum(o["numRowsRemoved"] for o in ops) >= 1          # closed windows left state
    latest = {r["window_start"].strftime("%H:%M"): r["total_logs"]
              for r in latest_features(spark, out).collect()}
    assert latest == {"00:00": 2, "00:15": 1, "00:30": 3}


def test_append_mode_emits_closed_windows_once(spark, tmp_dir):
    glob = _replay_files(spark, tmp_dir)
    out = os.path.join(tmp_dir, "table")
    q = start_feature_table(stream_features(_stream(spark, glob), W), out,
                            os.path.join(tmp_dir, "ckpt"), {"availableNow": True})
    run_until_idle(q)
    rows = sorted((r["window_start"].strftime("%H:%M"), r["total_logs"])
                  for r in spark.read.parquet(out).collect())
    # watermark ends at 00:42 - 15 min = 00:27: only windows ending by then
    assert rows == [("00:00", 2)]


def test_stream_equals_batch(spark, tmp_dir):
    out = os.path.join(tmp_dir, "changelog")
    logs = logs_from_event_files(spark, f"{SF001}/events*.parquet")
    run_until_idle(start_feature_changelog(stream_features(logs, "6 hours"), out,
                                           os.path.join(tmp_dir, "ckpt"),
                                           {"availableNow": True}))
    a = latest_features(spark, out)
    b = window_features(load_logs(spark, SF001), "6 hours")
    assert a.count() == b.count()
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def _rate_model():
    # identity scaling on error_rate only; other features scaled to ~0
    big = 1e12
    return ModelBundle(window=W, means=[0.0, 0.0, 0.0, 0.0], stds=[big, big, 1.0, big],
                       centers=[[0, 0, 0, 0], [0, 0, 10, 0], [0, 0, 50, 0]])


def _busy_window(start_min, errors, total=12, svc="a", prefix="X"):
    return [(f"2024-01-01T01:{start_min + i // 6:02d}:{(i * 7) % 60:02d}",
             "ERROR" if i < errors else "INFO", "msg", f"{prefix}-{start_min}-{i}", svc)
            for i in range(total)]


def test_detection_restart_from_checkpoint_is_exactly_once(spark, tmp_dir):
    inp = os.path.join(tmp_dir, "in")
    store, ckpt = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "ckpt")
    _write_batch(spark, inp, "b0", _busy_window(0, 6))          # 50 % errors -> HIGH
    glob = os.path.join(inp, "*")
    run_until_idle(start_detection(_stream(spark, glob), _rate_model(), store, ckpt,
                                   {"availableNow": True}))
    first = read_alerts(spark, store).collect()
    assert [(r["severity"], r["metadata"]["serviceName"]) for r in first] == [("HIGH", "a")]
    # new data arrives; restart on the same checkpoint
    _write_batch(spark, inp, "b1", _busy_window(30, 1, svc="b", prefix="Y"))  # 8.33 % -> MEDIUM
    run_until_idle(start_detection(_stream(spark, glob), _rate_model(), store, ckpt,
                                   {"availableNow": True}))
    got = sorted((r["severity"], r["metadata"]["serviceName"])
                 for r in read_alerts(spark, store).collect())
    assert got == [("HIGH", "a"), ("MEDIUM", "b")]
    # a second job on a fresh checkpoint re-sends everything: the store is unchanged
    run_until_idle(start_detection(_stream(spark, glob), _rate_model(), store,
                                   os.path.join(tmp_dir, "ckpt2"), {"availableNow": True}))
    assert read_alerts(spark, store).count() == 2


def test_processing_time_trigger(spark, tmp_dir):
    inp = os.path.join(tmp_dir, "in")
    _write_batch(spark, inp, "b0", _busy_window(0, 6))
    q = start_detection(_stream(spark, os.path.join(inp, "*")), _rate_model(),
                        os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "ckpt"),
                        {"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        assert q.isActive and q.lastProgress is not None
    finally:
        q.stop()
    assert read_alerts(spark, os.path.join(tmp_dir, "store")).count() == 1


def test_empty_batch_writes_nothing(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    empty = spark.createDataFrame([], "window_start timestamp, window_end timestamp, "
                                      "serviceName string, total_logs long, error_count long, "
                                      "avg_message_length double, error_rate double, "
                                      "prediction int")
    alert_batch_handler(store)(empty, 0)
    assert not os.path.exists(store)


def test_failure_surfaces(spark, tmp_dir):
    inp = os.path.join(tmp_dir, "in")
    _write_batch(spark, inp, "b0", _busy_window(0, 6))

    def boom(df, batch_id):
        raise RuntimeError("sink down")

    feats = stream_features(_stream(spark, os.path.join(inp, "*")), W)
    q = (feats.writeStream.outputMode("update").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(tmp_dir, "ckpt"))
         .foreachBatch(boom).start())
    with pytest.raises(Exception):
        run_until_idle(q)


def test_append_mode_detection_alerts_only_closed_windows(spark, tmp_dir):
    inp = os.path.join(tmp_dir, "in")
    store = os.path.join(tmp_dir, "store")
    _write_batch(spark, inp, "b0", _busy_window(0, 6))                  # 01:00 window, HIGH
    _write_batch(spark, inp, "b1", _busy_window(30, 6, svc="b", prefix="Y"))  # 01:30, HIGH
    run_until_idle(start_detection(_stream(spark, os.path.join(inp, "*")), _rate_model(),
                                   store, os.path.join(tmp_dir, "ckpt"),
                                   {"availableNow": True}, output_mode="append"))
    # watermark = 01:31 - 15 min = 01:16: only the 01:00 window is closed
    got = [(r["metadata"]["serviceName"], r["window_start"].strftime("%H:%M"))
           for r in read_alerts(spark, store).collect()]
    assert got == [("a", "01:00")]


def test_fold_changelog_keeps_current_view(spark, tmp_dir):
    from logwarden.streaming import current_features, fold_changelog
    glob = _replay_files(spark, tmp_dir)
    out, table = os.path.join(tmp_dir, "changelog"), os.path.join(tmp_dir, "folded")
    ckpt = os.path.join(tmp_dir, "ckpt")
    assert fold_changelog(spark, out, table) is None            # nothing yet
    # two micro-batches, fold, then the rest
    feats = stream_features(_stream(spark, glob), W)
    run_until_idle(start_feature_changelog(feats, out, ckpt, {"availableNow": True}))
    full = {r["window_start"].strftime("%H:%M"): r["total_logs"]
            for r in latest_features(spark, out).collect()}
    through = fold_changelog(spark, out, table)
    # the highest batch that wrote rows (a final no-data batch writes none)
    assert through == spark.read.parquet(out).agg({"batch_id": "max"}).first()[0]
    assert fold_changelog(spark, out, table) == through         # nothing new: no-op
    view = {r["window_start"].strftime("%H:%M"): r["total_logs"]
            for r in current_features(spark, out, table).collect()}
    assert view == full == {"00:00": 2, "00:15": 1, "00:30": 3}
    # more data after the fold: the view combines folded rows and new batches
    _write_batch(spark, os.path.join(tmp_dir, "in"), "b4",
                 [("2024-01-01T00:44:00", "ERROR", "m", "A-8", "a"),
                  ("2024-01-01T01:10:00", "INFO", "m", "A-9", "a")])
    run_until_idle(start_feature_changelog(stream_features(_stream(spark, glob), W), out,
                                           ckpt, {"availableNow": True}))
    view = {r["window_start"].strftime("%H:%M"): r["total_logs"]
            for r in current_features(spark, out, table).collect()}
    assert view == {"00:00": 2, "00:15": 1, "00:30": 4, "01:00": 1}
    fold_changelog(spark, out, table)
    assert {r["window_start"].strftime("%H:%M"): r["total_logs"]
            for r in current_features(spark, out, table).collect()} == view


def test_streaming_aggregate_combines_before_the_state_store(spark, tmp_dir):
    glob = _replay_files(spark, tmp_dir)
    q = start_feature_changelog(stream_features(_stream(spark, glob), W),
                                os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"),
                                {"availableNow": True}, state_partitions=3)
    run_until_idle(q)
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    # partial counts per task, one exchange into the given state partitions
    assert plan.index("StateStoreRestore") < plan.index("partial_count")
    assert "hashpartitioning(window" in plan and ", 3)" in plan
    assert "from_json" in plan and plan.count("from_json") == 1


def test_changelog_readers_before_any_batch(spark, tmp_dir):
    from logwarden.streaming import current_features, fold_changelog
    out = os.path.join(tmp_dir, "changelog")
    assert latest_features(spark, out).count() == 0
    assert fold_changelog(spark, out, os.path.join(tmp_dir, "folded")) is None
    assert current_features(spark, out, os.path.join(tmp_dir, "folded")).count() == 0
    # a batch without changed rows writes nothing
    from logwarden.streaming import changelog_writer
    empty = spark.createDataFrame([], "window_start timestamp, window_end timestamp, "
                                      "serviceName string, total_logs long")
    changelog_writer(out)(empty, 0)
    assert latest_features(spark, out).count() == 0


def test_crash_between_publish_and_store_then_restart(spark, tmp_dir):
    """Publish succeeded, the batch died before the store write; the restart
    re-runs the batch: the topic sees a resend (at least once), the store
    holds every alert exactly once."""
    from logwarden.sinks.topic import alert_publisher, decode_alert_records
    from logwarden.sources.topic import read_topic
    inp = os.path.join(tmp_dir, "in")
    store, topic, ckpt = (os.path.join(tmp_dir, n) for n in ("store", "topic", "ckpt"))
    _write_batch(spark, inp, "b0", _busy_window(0, 6) + _busy_window(30, 1, svc="b", prefix="Y"))
    real = alert_publisher(path=topic)
    calls = []

    def crashing(alerts):
        real(alerts)
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost before the store write")

    q = start_detection(_stream(spark, os.path.join(inp, "*")), _rate_model(), store, ckpt,
                        {"availableNow": True}, publish=crashing)
    with pytest.raises(Exception):
        run_until_idle(q)
    assert not os.path.exists(store) or read_alerts(spark, store).count() == 0
    run_until_idle(start_detection(_stream(spark, os.path.join(inp, "*")), _rate_model(),
                                   store, ckpt, {"availableNow": True}, publish=crashing))
    stored = read_alerts(spark, store)
    assert stored.count() == 2 and stored.select("id").distinct().count() == 2
    published = decode_alert_records(read_topic(spark, path=topic))
    assert published.count() == 4 and published.select("id").distinct().count() == 2


def test_retried_changelog_batch_replaces_its_output(spark, tmp_dir):
    from logwarden.streaming import changelog_writer
    glob = _replay_files(spark, tmp_dir)
    out, ckpt = os.path.join(tmp_dir, "changelog"), os.path.join(tmp_dir, "ckpt")
    write = changelog_writer(out)
    calls = []

    def crash_after_write(df, batch_id):
        write(df, batch_id)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost before the commit")

    def run():
        feats = stream_features(_stream(spark, glob), W)
        return (feats.writeStream.outputMode("update").trigger(availableNow=True)
                .option("checkpointLocation", ckpt).foreachBatch(crash_after_write).start())

    with pytest.raises(Exception):
        run_until_idle(run())
    run_until_idle(run())
    assert calls[0] == calls[1] == 0                 # batch 0 ran twice
    log = spark.read.parquet(out)
    b0 = log.filter("batch_id = 0")
    assert b0.count() == b0.select("window_start", "serviceName").distinct().count() == 1
    latest = {r["window_start"].strftime("%H:%M"): r["total_logs"]
              for r in latest_features(spark, out).collect()}
    assert latest == {"00:00": 2, "00:15": 1, "00:30": 3}


def test_half_written_fold_is_ignored(spark, tmp_dir):
    from logwarden.streaming import current_features, fold_changelog
    glob = _replay_files(spark, tmp_dir)
    out, table = os.path.join(tmp_dir, "changelog"), os.path.join(tmp_dir, "folded")
    run_until_idle(start_feature_changelog(stream_features(_stream(spark, glob), W), out,
                                           os.path.join(tmp_dir, "ckpt"), {"availableNow": True}))
    fold_changelog(spark, out, table)
    before = sorted(tuple(r) for r in current_features(spark, out, table).collect())
    # a fold that died after writing its version folder, before the pointer
    spark.createDataFrame([(1,)], "x int").write.parquet(os.path.join(table, "v-dead"))
    assert sorted(tuple(r) for r in current_features(spark, out, table).collect()) == before
