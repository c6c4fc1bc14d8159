"""Withdrawn alerts, silent services, late rows accounted for, state audit."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import make_logs
from logwarden.operators.features import window_features
from logwarden.sinks.alert_store import (alert_states, compact_alerts, insert_alerts, read_alerts,
                                         withdraw_alerts)
from logwarden.sources.codec import encode_logs
from logwarden.sources.topic import read_topic_stream
from logwarden.streaming import alert_batch_handler, logs_from_records, run_until_idle
from logwarden.streaming.watch import (accounted_rows, late_row_accountant, open_windows, service_sessions,
                                       silent_services, start_late_accounting, start_session_table)
from test_store_versions import alerts, rates, scored

RECORDS = "key binary, value binary, topic string"


def states(spark, store):
    return sorted(((r.metadata.serviceName, r.severity, r.state) for r in
                   alert_states(spark, store).collect()), key=str)


# ------------------------------------------------------------- withdrawal ---

def test_an_alert_opens_refreshes_goes_and_comes_back(spark, tmp_dir):
    store, handle = f"{tmp_dir}/s", alert_batch_handler(f"{tmp_dir}/s", withdraw=True)
    handle(scored(spark, [(1, "a", 20, 2), (1, None, 20, 2), (2, "a", 30, 2)]), 0)
    assert len(rates(spark, store)) == 3 and {s for *_, s in states(spark, store)} == {"open"}
    handle(scored(spark, [(1, "a", 25, 2), (1, None, 1, 0)]), 1)
    assert rates(spark, store) == [("a", 25.0), ("a", 30.0)]
    assert states(spark, store) == [("a", "HIGH", "open"), ("a", "HIGH", "refreshed"), (None, "HIGH", "withdrawn")]
    handle(scored(spark, [(1, "a", 25, 0), (1, None, 20, 2)]), 2)          # the same value, raised again
    assert rates(spark, store) == [("a", 30.0), (None, 20.0)]
    compact_alerts(spark, store, "9999-12-31")
    assert rates(spark, store) == [("a", 30.0), (None, 20.0)]
    handle(scored(spark, [(1, "a", 25, 2)]), 3)
    assert rates(spark, store) == [("a", 25.0), ("a", 30.0), (None, 20.0)]


def test_another_severity_takes_the_place_of_the_first(spark, tmp_dir):
    store, handle = f"{tmp_dir}/s", alert_batch_handler(f"{tmp_dir}/s", withdraw=True)
    handle(scored(spark, [(1, "a", 10, 1)]), 0)
    handle(scored(spark, [(1, "a", 20, 2)]), 1)
    assert states(spark, store) == [("a", "HIGH", "open"), ("a", "MEDIUM", "withdrawn")]


def test_a_retried_batch_adds_no_version(spark, tmp_dir):
    store, handle = f"{tmp_dir}/s", alert_batch_handler(f"{tmp_dir}/s", withdraw=True)
    handle(scored(spark, [(1, "a", 20, 2)]), 0)
    for _ in range(2):
        handle(scored(spark, [(1, "a", 1, 0)]), 1)
    assert spark.read.parquet(store).count() == 2 and rates(spark, store) == []


def test_windows_of_other_dates_and_empty_batches_change_nothing(spark, tmp_dir):
    store = f"{tmp_dir}/s"
    withdraw_alerts(spark, scored(spark, [(1, "a", 1, 0)]), alerts(spark, []), store)
    insert_alerts(spark, alerts(spark, [(1, "a", 20, 2)]), store)
    for judged in ([(2, "a", 1, 0)], [(1, "b", 1, 0)], []):
        withdraw_alerts(spark, scored(spark, judged), alerts(spark, []), store)
    assert rates(spark, store) == [("a", 20.0)]


def test_stores_without_the_mark_are_read(spark, tmp_dir):
    store = f"{tmp_dir}/s"
    insert_alerts(spark, alerts(spark, [(1, "a", 20, 2)]), f"{tmp_dir}/new")
    spark.read.parquet(f"{tmp_dir}/new").drop("withdrawn").write.partitionBy("window_date").parquet(store)
    assert rates(spark, store) == [("a", 20.0)]
    insert_alerts(spark, alerts(spark, [(1, "a", 20, 2)]), store)
    assert spark.read.parquet(store).count() == 1


# ---------------------------------------------------------------- streams ---

def slices(spark, base, *batches):
    """Each batch of (minute, service) rows as one file of the topic."""
    for i, rows in enumerate(batches):
        logs = make_logs(spark, [(None if m is None else f"2024-01-01T{m // 60:02d}:{m % 60:02d}:00",
                                  "ERROR" if m == 5 else "INFO", "m", f"A-{i}-{j}", s)
                                 for j, (m, s) in enumerate(rows)])
        path = os.path.join(base, "in", f"b{i}")
        if not os.path.exists(path):
            encode_logs(logs).coalesce(1).write.parquet(path)
    return logs_from_records(read_topic_stream(spark, path=os.path.join(base, "in", "*"), schema=RECORDS,
                                               max_files_per_trigger=1))


def hm(t):
    return t and t.strftime("%H:%M")


def test_silences_over_a_restart(spark, tmp_dir):
    first = [(0, "a"), (5, "a"), (14, "a"), (3, "b"), (None, "a"), (40, "a"), (7, None)]
    second = [(49, "a"), (120, "b"), (125, "a"), (300, "a")]
    for stop in (1, 2):
        logs = slices(spark, tmp_dir, *(first, second)[:stop])
        run_until_idle(start_session_table(logs, "10 minutes", f"{tmp_dir}/out", f"{tmp_dir}/ck",
                                           trigger={"availableNow": True}, state_partitions=2))
    got = sorted(((r.serviceName, hm(r.silent_from), hm(r.back_at)) for r in
                  silent_services(spark.read.parquet(f"{tmp_dir}/out")).collect()), key=str)
    assert got == [("a", "00:14", "00:40"), ("a", "00:49", "02:05"), ("a", "02:05", None),
                   ("b", "00:03", "02:00"), ("b", "02:00", None), (None, "00:07", None)]


def test_sessions_of_a_batch(spark):
    logs = make_logs(spark, [("2024-01-01T00:00:00", "INFO", "m", "A", "a"), ("2024-01-01T00:09:59", "INFO", "m", "B", "a"),
                             ("2024-01-01T00:20:00", "INFO", "m", "C", "a"), (None, "INFO", "m", "D", "a")])
    rows = service_sessions(logs, "10 minutes").orderBy("first_log").collect()
    assert [(r.total_logs, hm(r.last_log)) for r in rows] == [(2, "00:09"), (1, "00:20")]


def test_late_rows_are_accounted_for(spark, tmp_dir):
    batches = ([(1, "a"), (5, "a"), (None, "b")], [(50, "a"), (2, "b")], [(3, "a"), (20, "a"), (34, "b"), (36, "a")], [])
    logs = slices(spark, tmp_dir, *batches[:3])
    run_until_idle(start_late_accounting(logs, f"{tmp_dir}/out", "15 minutes", f"{tmp_dir}/ck",
                                         trigger={"availableNow": True}))
    rows = accounted_rows(spark, f"{tmp_dir}/out").collect()
    assert len(rows) == sum(map(len, batches))
    by = Counter((r.batch_id, r.reason) for r in rows)
    # the third batch meets the watermark 00:35: windows up to 00:30 have ended
    assert by == {(0, None): 2, (0, "missing_timestamp"): 1, (1, None): 2, (2, None): 2, (2, "window_closed"): 2}
    assert all(r.late == (r.reason is not None) for r in rows)
    kept = accounted_rows(spark, f"{tmp_dir}/out").filter("not late")
    assert window_features(kept, "15 minutes").agg(F.sum("total_logs")).first()[0] == 6


def test_a_retried_batch_splits_as_before(spark, tmp_dir):
    handle = late_row_accountant(f"{tmp_dir}/out", "15 minutes", "15 minutes")
    one = make_logs(spark, [("2024-01-01T02:00:00", "INFO", "m", "A", "a")])
    two = make_logs(spark, [("2024-01-01T01:00:00", "INFO", "m", "B", "a"), ("2024-01-01T05:00:00", "INFO", "m", "C", "a")])
    for batch, i in ((one, 0), (two, 1), (two, 1), (one, 0), (two.limit(0), 2)):
        handle(batch, i)
    got = Counter((r.batch_id, r.reason) for r in accounted_rows(spark, f"{tmp_dir}/out").collect())
    assert got == {(0, None): 1, (1, None): 1, (1, "window_closed"): 1}


def test_open_windows_of_a_checkpoint(spark, tmp_dir):
    from logwarden.streaming import start_feature_changelog, stream_features

    logs = slices(spark, tmp_dir, [(1, "a"), (5, "a"), (7, None)], [(40, "a"), (41, "b")])
    run_until_idle(start_feature_changelog(stream_features(logs, "15 minutes"), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                                           {"availableNow": True}, state_partitions=2))
    got = sorted((hm(r.window_start), r.serviceName, r.total_logs, r.error_count)
                 for r in open_windows(spark, f"{tmp_dir}/ck").collect())
    assert got == [("00:30", "a", 1, 0), ("00:30", "b", 1, 0)]      # 00:00 ended by 00:26


# ------------------------------------------------------------ counts by date ---

def test_counts_follow_inserts_withdrawals_and_compaction(spark, tmp_dir):
    from logwarden.sinks.alert_counts import alert_dates, refresh_counts, stored_severity_counts

    store, counts = f"{tmp_dir}/s", f"{tmp_dir}/c"
    handle = alert_batch_handler(store, withdraw=True)

    def after(rows):
        batch = scored(spark, rows)
        handle(batch, 0)
        refresh_counts(spark, store, counts, alert_dates(batch))
        return tuple(stored_severity_counts(spark, counts).first())

    assert tuple(stored_severity_counts(spark, counts).first()) == (0, 0, 0)
    assert after([(1, "a", 20, 2), (1, "b", 10, 1), (2, "a", 20, 2)]) == (2, 1, 0)
    assert after([(1, "a", 25, 2)]) == (2, 1, 0)                    # refreshed: counted once
    assert after([(2, "a", 1, 0)]) == (1, 1, 0)                     # the date's only alert goes
    compact_alerts(spark, store, "9999-12-31")
    assert after([]) == (1, 1, 0)
    insert_alerts(spark, alerts(spark, [(3, "c", 20, 2)]), store)   # a date nobody asked for yet
    assert after([(1, "a", 25, 2)]) == (1, 1, 0) and after([(3, "d", 1, 0)]) == (2, 1, 0)
