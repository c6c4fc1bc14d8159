"""Alert store over many batches, storage errors, versions and job options."""

import glob

import pytest
from pyspark.sql import functions as F

from conftest import make_logs
from logwarden import jobs
from logwarden.functions import seconds
from logwarden.operators.alerts import alert_records
from logwarden.operators.features import window_features
from logwarden.operators.model import (MAX_CLUSTERS, load_bundle, model_exists, save_bundle, train)
from logwarden.operators.profile import observed_mix, service_gaps
from logwarden.schemas import FEATURE_SCHEMA
from logwarden.session import clear_scratch, path_exists, scratch_path
from logwarden.sinks import alert_store, snapshot
from logwarden.sinks.alert_store import compact_alerts, insert_alerts, read_alerts
from logwarden.sources import topic
from logwarden.streaming import fold_changelog
from logwarden.streaming.detector import _latest, changelog_writer, current_features


def scored(spark, rows):
    """(day, service, rate, cluster) -> scored feature rows with 100 logs."""
    data = [(f"2024-01-{d:02d} 00:00:00", s, 100, float(r), p) for d, s, r, p in rows]
    return spark.createDataFrame(data, "t string, serviceName string, total_logs long, "
                                 "error_rate double, prediction int").select(
        F.to_timestamp("t").alias("window_start"),
        (F.to_timestamp("t") + F.expr("INTERVAL 15 MINUTES")).alias("window_end"),
        "serviceName", "total_logs", "error_rate", "prediction")


def alerts(spark, rows):
    return alert_records(scored(spark, rows))


def rates(spark, store):
    return sorted(((r.metadata.serviceName, r.metadata.errorRate) for r in
                   read_alerts(spark, store).collect()), key=str)


def test_null_and_empty_service_are_two_alerts(spark, tmp_dir):
    rows = alerts(spark, [(1, None, 20, 2), (1, "", 30, 2)])
    assert len({r.id for r in rows.collect()}) == 2
    insert_alerts(spark, rows, f"{tmp_dir}/s")
    assert rates(spark, f"{tmp_dir}/s") == [("", 30.0), (None, 20.0)]


def test_a_resend_with_another_rate_replaces_the_value(spark, tmp_dir):
    store = f"{tmp_dir}/s"
    for rate in (20, 80, 80):
        insert_alerts(spark, alerts(spark, [(1, "a", rate, 2), (2, "b", 50, 2)]), store, unique=True)
    assert rates(spark, store) == [("a", 80.0), ("b", 50.0)]
    stored = spark.read.parquet(store)
    assert stored.count() == 3 and stored.agg(F.max("version")).first()[0] == 1


def test_an_insert_during_compaction_is_kept(spark, tmp_dir, monkeypatch):
    store = f"{tmp_dir}/s"
    insert_alerts(spark, alerts(spark, [(1, "a", 20, 2)]), store)
    insert_alerts(spark, alerts(spark, [(1, "b", 20, 2)]), store)
    real = alert_store.sized_by_date

    def meanwhile(rows, per_file=None):
        monkeypatch.setattr(alert_store, "sized_by_date", real)
        insert_alerts(spark, alerts(spark, [(1, "a", 90, 2), (1, "c", 30, 2)]), store)
        return real(rows, per_file)

    monkeypatch.setattr(alert_store, "sized_by_date", meanwhile)
    compact_alerts(spark, store, "2024-02-01")
    assert rates(spark, store) == [("a", 90.0), ("b", 20.0), ("c", 30.0)]


def test_a_crash_before_the_old_files_go_loses_and_doubles_nothing(spark, tmp_dir, monkeypatch):
    store = f"{tmp_dir}/s"
    insert_alerts(spark, alerts(spark, [(1, "a", 20, 2), (2, "b", 30, 2)]), store)
    before = rates(spark, store)

    def crash(spark, path):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(alert_store, "delete_path", crash)
        with pytest.raises(RuntimeError, match="lost"):
            compact_alerts(spark, store, "2024-02-01")
    assert rates(spark, store) == before
    compact_alerts(spark, store, "2024-02-01")
    assert rates(spark, store) == before and spark.read.parquet(store).count() == 2


def test_files_follow_each_date(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(alert_store, "ROWS_PER_FILE", 10)
    insert_alerts(spark, alerts(spark, [(d, f"s{i}", 20, 2) for d in range(1, 21)
                                        for i in range(10)]), f"{tmp_dir}/a")
    assert len(glob.glob(f"{tmp_dir}/a/window_date=*/*.parquet")) == 20
    insert_alerts(spark, alerts(spark, [(1, f"s{i}", 20, 2) for i in range(200)]), f"{tmp_dir}/b")
    assert len(glob.glob(f"{tmp_dir}/b/window_date=*/*.parquet")) > 5


def test_storage_errors_surface(spark, tmp_dir):
    bad = "nosuch://x/y"
    rows = alerts(spark, [(1, "a", 20, 2)])
    for act in (lambda: path_exists(spark, bad), lambda: model_exists(spark, bad),
                lambda: read_alerts(spark, bad), lambda: insert_alerts(spark, rows, bad),
                lambda: fold_changelog(spark, bad, bad)):
        with pytest.raises(Exception, match="nosuch"):
            act()
    missing = f"{tmp_dir}/none"
    assert not path_exists(spark, missing) and not model_exists(spark, missing)
    assert read_alerts(spark, missing).count() == 0


def feature_rows(spark, n):
    return spark.range(n).select(
        F.timestamp_seconds(F.col("id") * 900).alias("window_start"),
        F.timestamp_seconds(F.col("id") * 900 + 900).alias("window_end"),
        F.concat(F.lit("s"), F.col("id") % 7).alias("serviceName"),
        (F.col("id") % 50 + 1).alias("total_logs"), (F.col("id") % 11).alias("error_count"),
        (F.col("id") % 13 + 0.5).alias("avg_message_length"),
        F.round(F.pmod(F.hash("id"), F.lit(10000)) / 100, 2).alias("error_rate"))


def test_fit_does_not_depend_on_the_session(spark):
    feats = feature_rows(spark, 6000)
    before, centers = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("2", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            centers.append(train(feats, "15 minutes").centers)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for a, b in zip(*centers):
        assert a == pytest.approx(b, rel=1e-9, abs=1e-12)


def test_one_cluster_limit_and_durations(spark, tmp_dir):
    with pytest.raises(ValueError, match="clusters"):
        train(feature_rows(spark, 5), "15 minutes", k=MAX_CLUSTERS + 1)
    assert seconds("15 minutes") == seconds("900 seconds") == seconds("INTERVAL '15' MINUTE")
    assert seconds("1 hour 30 minutes") == 5400
    with pytest.raises(ValueError):
        seconds("soon")
    save_bundle(spark, train(feature_rows(spark, 50), "15 minutes"), f"{tmp_dir}/m")
    assert load_bundle(spark, f"{tmp_dir}/m", "900 seconds").k == 3
    with pytest.raises(ValueError, match="windows"):
        load_bundle(spark, f"{tmp_dir}/m", "5 minutes")


class Reader:
    """Stands in for spark.read / readStream and keeps what it was told."""

    def __init__(self):
        self.told = {}
        self.read = self.readStream = self

    def format(self, f):
        self.told["format"] = f
        return self

    def option(self, k, v):
        self.told[k] = v
        return self

    def options(self, **kw):
        self.told |= kw
        return self

    def load(self):
        raise StopIteration


def test_streams_fail_on_lost_offsets_by_default():
    for asked, want in (({}, "true"), ({"fail_on_data_loss": False}, "false")):
        r = Reader()
        with pytest.raises(StopIteration):
            topic.read_topic_stream(r, servers="h:1", **asked)
        assert r.told["failOnDataLoss"] == want
    r = Reader()
    with pytest.raises(StopIteration):
        topic.read_topic(r, servers="h:1")
    assert r.told["failOnDataLoss"] == "false"


def test_a_database_is_read_in_parallel():
    with pytest.raises(ValueError, match="parallel"):
        snapshot.read_snapshot(Reader(), jdbc_url="jdbc:x")
    r = Reader()
    with pytest.raises(StopIteration):
        snapshot.read_snapshot(r, jdbc_url="jdbc:x", user="u", password="p", driver="d",
                               partition_column="timestamp", lower_bound="2024-01-01",
                               upper_bound="2024-02-01", num_partitions=16)
    assert r.told == {"format": "jdbc", "url": "jdbc:x", "dbtable": "training_logs", "user": "u",
                      "password": "p", "driver": "d", "partitionColumn": "timestamp",
                      "lowerBound": "2024-01-01", "upperBound": "2024-02-01", "numPartitions": "16"}


def test_job_options_reach_the_stream(monkeypatch):
    seen = {}
    monkeypatch.setenv("PW", "secret")
    monkeypatch.setattr(jobs, "build_session", lambda master: None)

    def start(spark, cfg):
        seen["cfg"] = cfg
        raise StopIteration

    monkeypatch.setattr(jobs, "start_detector", start)
    with pytest.raises(StopIteration):
        jobs.main(["--model", "m", "--store", "s", "--output-mode", "append", "--watermark", "1 hour",
                   "--state-partitions", "7", "--allow-data-loss", "--jdbc-url", "j",
                   "--jdbc-user", "u", "--jdbc-password-env", "PW", "--jdbc-driver", "d"])
    c = seen["cfg"]
    assert (c.output_mode, c.watermark, c.state_partitions, c.fail_on_data_loss) == (
        "append", "1 hour", 7, False)
    assert (c.jdbc_url, c.jdbc_user, c.jdbc_password, c.jdbc_driver) == ("j", "u", "secret", "d")


def batch(spark, days, total):
    return spark.createDataFrame(
        [(d, total) for d in days], "d int, n long").select(
        F.to_timestamp(F.format_string("2024-01-%02d", "d")).alias("window_start"),
        F.to_timestamp(F.format_string("2024-01-%02d 06", "d")).alias("window_end"),
        F.lit("a").alias("serviceName"), F.col("n").alias("total_logs"), F.lit(1).cast("long").alias(
            "error_count"), F.lit(2.0).alias("avg_message_length"), F.lit(3.0).alias("error_rate"))


def test_a_fold_rewrites_only_touched_dates(spark, tmp_dir):
    log, table = f"{tmp_dir}/log", f"{tmp_dir}/table"
    write = changelog_writer(log)
    write(batch(spark, [1, 2, 3], 10), 0)
    assert fold_changelog(spark, log, table) == 0
    first = set(glob.glob(f"{table}/v-*/data/window_date=*/*.parquet"))
    write(batch(spark, [3], 11), 1)
    assert fold_changelog(spark, log, table) == 1
    added = set(glob.glob(f"{table}/v-*/data/window_date=*/*.parquet")) - first
    assert {a.split("window_date=")[1][:10] for a in added} == {"2024-01-03"}
    write(batch(spark, [4], 12), 2)
    assert fold_changelog(spark, log, table) == 2
    assert not glob.glob(f"{log}/batch_id=0")                   # folded long ago
    got = {r.window_start.day: r.total_logs for r in current_features(spark, log, table).collect()}
    assert got == {1: 10, 2: 10, 3: 11, 4: 12}
    assert current_features(spark, log, table).schema.names == FEATURE_SCHEMA.names


def test_the_latest_rows_come_from_a_hash_aggregate(spark):
    log = batch(spark, [1], 1).withColumn("batch_id", F.lit(0).cast("long"))
    plan = _latest(log)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_long_gaps_and_whole_shares(spark):
    logs = make_logs(spark, [("2024-01-01T00:00:00", "INFO", "m", "a", "s"),
                             ("2024-03-01T00:00:00", "WARN", "m", "b", "s"),
                             ("2024-02-01T00:00:00", "ERROR", "m", "c", "s")])
    row = observed_mix(logs).first()
    assert row.delay_ms == 30 * 86400 * 1000
    assert (row.info_rate, row.warn_rate, row.error_rate) == (34, 33, 33)
    plan = service_gaps(logs)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    feats = window_features(logs, "1 day")
    assert feats.count() == 3


def test_scratch_folders_can_be_cleared(spark):
    path = scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    assert path_exists(spark, path) and clear_scratch(spark) >= 1
    assert not path_exists(spark, path)


def test_a_reader_that_listed_before_a_compaction_with_grace_goes_on(spark, tmp_dir):
    store = f"{tmp_dir}/s"
    for rate in (20, 25):
        insert_alerts(spark, alerts(spark, [(1, "a", rate, 2), (2, "b", 30, 2)]), store)
    before = rates(spark, store)
    listed = read_alerts(spark, store)                       # files are listed here, read below
    compact_alerts(spark, store, "2024-02-01", grace_s=3600)
    assert sorted(r.metadata.errorRate for r in listed.collect()) == sorted(r for _, r in before)
    assert rates(spark, store) == before
    stored = spark.read.parquet(store).count()
    compact_alerts(spark, store, "2024-02-01", grace_s=3600)  # replaced files are not taken again
    compact_alerts(spark, store, "2024-02-01", grace_s=3600)
    lists = list(alert_store._retired(spark, store).values())
    assert len(lists) == 3 and len({f for files in lists for f in files}) == sum(map(len, lists))
    insert_alerts(spark, alerts(spark, [(3, "c", 40, 2)]), store)
    assert rates(spark, store) == sorted([*before, ("c", 40.0)], key=str)
    assert stored == 5                                        # three rows replaced, two live
    assert alert_store.purge_retired(spark, store, 3600) == 0
    assert alert_store.purge_retired(spark, store) > 0
    assert alert_store.purge_retired(spark, store) == 0
    assert spark.read.parquet(store).count() == 3
    assert rates(spark, store) == sorted([*before, ("c", 40.0)], key=str)
