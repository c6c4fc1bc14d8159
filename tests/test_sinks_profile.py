"""Training snapshot (files), level mix, gaps and mix rules."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, make_logs
from logwarden.operators.profile import (check_mix_rules, observed_mix, service_gaps,
                                         service_level_mix)
from logwarden.schemas import LOG_COLUMNS, MIX_SCHEMA
from logwarden.sinks.snapshot import read_snapshot, snapshot_logs
from logwarden.sources.fixtures import load_logs


def test_snapshot_overwrites_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "training_logs")
    logs = load_logs(spark, SF001)
    snapshot_logs(logs, path=path)
    snapshot_logs(logs, path=path)                     # overwrite, not append
    back = read_snapshot(spark, path=path)
    assert back.columns == LOG_COLUMNS
    assert back.count() == logs.count()
    assert back.exceptAll(logs).count() == 0


def test_level_mix_and_target_difference(spark):
    rows = ([("2024-01-01T00:00:00", "INFO", "m", "a", "s")] * 7
            + [("2024-01-01T00:00:01", "WARN", "m", "b", "s")] * 2
            + [("2024-01-01T00:00:02", "ERROR", "m", "c", "s")])
    r = service_level_mix(make_logs(spark, rows)).first()
    assert (r["info_pct"], r["warn_pct"], r["error_pct"]) == (70.0, 20.0, 10.0)
    assert (r["info_diff"], r["warn_diff"], r["error_diff"]) == (0.0, 0.0, 0.0)


def test_mean_gap_equals_consecutive_differences(spark):
    logs = load_logs(spark, SF001)
    w = Window.partitionBy("serviceName").orderBy("timestamp", "relatedObjectId")
    brute = (logs.withColumn("gap", F.unix_micros("timestamp")
                             - F.unix_micros(F.lag("timestamp").over(w)))
             .groupBy("serviceName")
             .agg(F.round(F.avg("gap") / 1000.0, 3).alias("g")))
    ours = {r["serviceName"]: r["mean_gap_ms"] for r in service_gaps(logs).collect()}
    for r in brute.collect():
        assert ours[r["serviceName"]] == pytest.approx(r["g"], abs=1e-3)
    act = {r["serviceName"]: r["active"] for r in service_gaps(logs, "1 hour").collect()}
    assert any(act.values())


def test_mix_rules_on_f6_fixture(spark):
    mix = spark.createDataFrame([("normal", 70, 20, 10, 200), ("anomalous", 40, 20, 40, 200),
                                 ("bad-sum", 70, 20, 20, 200), ("bad-delay", 70, 20, 10, 0)],
                                MIX_SCHEMA)
    got = {r["serviceName"]: (r["valid"], r["reason"]) for r in check_mix_rules(mix).collect()}
    assert got["normal"] == (True, None)
    assert got["anomalous"] == (True, None)
    assert got["bad-sum"] == (False, "rates must sum to 100")
    assert got["bad-delay"] == (False, "delay must be at least 1 ms")


def test_observed_mix_is_one_aggregate(spark):
    plan = observed_mix(load_logs(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    rows = check_mix_rules(observed_mix(load_logs(spark, SF001))).collect()
    assert len(rows) == 3 and all(r["delay_ms"] >= 1 for r in rows)
