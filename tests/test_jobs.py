"""End-to-end detector job on offline topic files (no broker)."""

import os

import pytest

from conftest import SF001
from logwarden.jobs import DetectorConfig, ensure_detector_model, start_detector
from logwarden.operators.model import model_exists
from logwarden.sinks.alert_store import read_alerts
from logwarden.sinks.topic import decode_alert_records, publish_records
from logwarden.sources.codec import encode_logs
from logwarden.sources.fixtures import load_logs
from logwarden.sources.topic import read_topic
from logwarden.streaming import run_until_idle


def _stamps(folder):
    return sorted((f, os.stat(os.path.join(folder, f)).st_mtime_ns) for f in os.listdir(folder))


def _cfg(base, **kw):
    return DetectorConfig(model_path=f"{base}/model", store_path=f"{base}/store",
                          window="1 day", records_path=f"{base}/topic",
                          snapshot_path=f"{base}/snapshot", alerts_path=f"{base}/alerts",
                          checkpoint=f"{base}/ckpt", trigger={"availableNow": True},
                          starting_offsets="earliest", **kw)


def test_train_then_detect_then_reuse(spark, tmp_dir):
    publish_records(encode_logs(load_logs(spark, SF001)), path=f"{tmp_dir}/topic")
    cfg = _cfg(tmp_dir)
    run_until_idle(start_detector(spark, cfg))
    assert model_exists(spark, cfg.model_path)
    snap = spark.read.parquet(cfg.snapshot_path)
    assert snap.count() == spark.read.parquet(f"{SF001}/events.parquet").count()
    stored = read_alerts(spark, cfg.store_path)
    n = stored.count()
    assert n > 0
    published = decode_alert_records(read_topic(spark, path=cfg.alerts_path))
    assert published.count() == n
    assert {r["severity"] for r in stored.collect()} <= {"HIGH", "MEDIUM"}
    # second start: model reused (no new snapshot), nothing stored twice
    before = _stamps(cfg.snapshot_path)
    run_until_idle(start_detector(spark, _cfg(tmp_dir)))
    assert _stamps(cfg.snapshot_path) == before          # no new training snapshot
    assert read_alerts(spark, cfg.store_path).count() == n


def test_window_mismatch_is_an_error(spark, tmp_dir):
    with pytest.raises(ValueError):
        ensure_detector_model(spark, _cfg(tmp_dir, training_window="5 minutes"))


def test_command_line_entry(spark, tmp_dir):
    from logwarden.jobs import main
    publish_records(encode_logs(load_logs(spark, SF001)), path=f"{tmp_dir}/topic")
    main(["--records", f"{tmp_dir}/topic", "--model", f"{tmp_dir}/model",
          "--store", f"{tmp_dir}/store", "--window", "1 day",
          "--checkpoint", f"{tmp_dir}/ckpt", "--trigger", "available-now"])
    assert model_exists(spark, f"{tmp_dir}/model")
    assert read_alerts(spark, f"{tmp_dir}/store").count() > 0


def test_explicit_window_mismatch_reproduces_original_setup(spark, tmp_dir):
    """Train on 5-minute windows, score 1-day windows, only when asked."""
    from logwarden.operators.model import load_bundle
    publish_records(encode_logs(load_logs(spark, SF001)), path=f"{tmp_dir}/topic")
    cfg = _cfg(tmp_dir, training_window="5 minutes", allow_window_mismatch=True)
    run_until_idle(start_detector(spark, cfg))
    assert load_bundle(spark, cfg.model_path).window == "5 minutes"
    stored = read_alerts(spark, cfg.store_path).collect()
    assert all((r["window_end"] - r["window_start"]).days == 1 for r in stored)


def test_alert_report(spark, tmp_dir, capsys):
    from logwarden.report import main as report_main
    from logwarden.report import report
    publish_records(encode_logs(load_logs(spark, SF001)), path=f"{tmp_dir}/topic")
    cfg = _cfg(tmp_dir)
    run_until_idle(start_detector(spark, cfg))
    n = read_alerts(spark, cfg.store_path).count()
    counts = report(spark, cfg.store_path)
    assert counts["high_count"] + counts["medium_count"] == n and counts["low_count"] == 0
    report_main(["--store", cfg.store_path, "--out", f"{tmp_dir}/listing"])
    assert capsys.readouterr().out.splitlines()[0].startswith("HIGH ")
    listed = spark.read.option("header", "true").csv(f"{tmp_dir}/listing")
    assert listed.count() == n                       # every alert, no page
    assert report(spark, f"{tmp_dir}/no-store") == {
        "high_count": 0, "medium_count": 0, "low_count": 0}
