"""Progress rows, read caps and triggers of streams."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from conftest import make_logs
from logwarden.session import child_names, write_text
from logwarden.sources.codec import encode_logs
from logwarden.sources.topic import read_topic_stream
from logwarden.streaming import logs_from_records, start_feature_changelog, stream_features
from logwarden.streaming.progress import (ProgressRecorder, read_progress, run_until_caught_up,
                                          trigger_gaps)

RECORDS = "key binary, value binary, topic string"


def write_files(spark, path, sizes):
    """One topic file for each size, oldest first, an hour of logs apart."""
    for n, rows in enumerate(sizes):
        logs = make_logs(spark, [(f"2024-01-01T{n:02d}:00:{i:02d}", "INFO", "m", f"E{i}", "a")
                                 for i in range(rows)])
        encode_logs(logs).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)                             # files are taken by modification time


def features(spark, path, out, ckpt, trigger, cap=1):
    records = read_topic_stream(spark, path=path, schema=RECORDS, max_files_per_trigger=cap)
    return start_feature_changelog(stream_features(logs_from_records(records), "15 minutes"), out, ckpt,
                                   trigger, state_partitions=2)


def test_rows_per_batch_watermark_and_restart(spark, tmp_dir):
    topic, out, ckpt, told = (f"{tmp_dir}/{n}" for n in ("topic", "out", "ckpt", "told"))
    write_files(spark, topic, [3, 5, 2])
    with ProgressRecorder(spark, told) as recorder:
        recorder.wait(features(spark, topic, out, ckpt, {"availableNow": True}))
    rows = read_progress(spark, told).orderBy("batch_id").collect()
    assert [r.input_rows for r in rows if r.input_rows] == [3, 5, 2]
    assert rows[1].watermark >= dt.datetime(2023, 12, 31, 23, 45)
    assert all(r.state_rows >= 0 and r.end_offset.startswith("[") for r in rows)
    before = len(rows)
    write_files(spark, topic, [1])
    with ProgressRecorder(spark, told) as recorder:              # goes on under the same query id
        recorder.wait(features(spark, topic, out, ckpt, {"availableNow": True}))
    again = read_progress(spark, told).collect()
    assert len({r.query_id for r in again}) == 1 and len({r.run_id for r in again}) == 2
    assert len(again) > before and sum(r.input_rows for r in again) == 11


def test_processing_time_triggers_keep_their_distance(spark, tmp_dir):
    topic, told = f"{tmp_dir}/topic", f"{tmp_dir}/told"
    write_files(spark, topic, [2, 2, 2])
    with ProgressRecorder(spark, told) as recorder:
        recorder.wait(run_until_caught_up(
            features(spark, topic, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", {"processingTime": "2 seconds"})))
    g = trigger_gaps(read_progress(spark, told)).first()
    assert (g.batches, g.most_rows) == (3, 2)
    assert g.last_start - g.first_start > dt.timedelta(seconds=1.9)


def test_a_failing_stream_and_a_failing_write_are_raised(spark, tmp_dir):
    topic = f"{tmp_dir}/topic"
    write_files(spark, topic, [2])
    stream = read_topic_stream(spark, path=topic, schema=RECORDS)
    bad = stream.select(F.raise_error(F.lit("boom")).alias("x"))
    with ProgressRecorder(spark, f"{tmp_dir}/told") as recorder:
        with pytest.raises(Exception, match="boom"):
            recorder.wait(bad.writeStream.format("noop").option("checkpointLocation", f"{tmp_dir}/c1")
                          .trigger(availableNow=True).start())
    write_text(spark, f"{tmp_dir}/file", "a file where a folder should be")
    with ProgressRecorder(spark, f"{tmp_dir}/file") as recorder:
        with pytest.raises(Exception):
            recorder.wait(stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_dir}/c2")
                          .trigger(availableNow=True).start())


def test_no_progress_yet_and_replaced_files(spark, tmp_dir):
    assert read_progress(spark, f"{tmp_dir}/none").count() == 0
    for text in ("one", "two"):
        write_text(spark, f"{tmp_dir}/d/x.json", text)
    assert open(f"{tmp_dir}/d/x.json").read() == "two"
    assert [n for n in child_names(spark, f"{tmp_dir}/d") if not n.startswith(".")] == ["x.json"]


def test_limits_that_have_no_effect_are_errors(spark, tmp_dir):
    with pytest.raises(ValueError):
        read_topic_stream(spark, path=tmp_dir, starting_offsets="latest")
    with pytest.raises(ValueError):
        read_topic_stream(spark, path=tmp_dir, max_offsets_per_trigger=5)
    with pytest.raises(ValueError):
        read_topic_stream(spark, servers="x:1", max_files_per_trigger=5)


def test_each_slice_of_a_topic_is_written_by_a_task_of_its_own(spark):
    from logwarden.plans.catalog import _one_file_a_slice
    logs = make_logs(spark, [(f"2024-01-01T{n % 4:02d}:00:00", "INFO", "m", f"E{n}", "a") for n in range(40)])
    path = _one_file_a_slice(spark, logs.repartition(3), F.hour("timestamp"), 4)
    found = spark.read.parquet(path).select("slice", F.input_file_name().alias("file")).groupBy(
        "slice", F.regexp_extract("file", r"part-(\d+)", 1).cast("int").alias("task"), "file").count().collect()
    assert sorted((r.slice, r.task, r["count"]) for r in found) == [(s, s, 10) for s in range(4)]


def test_slices_arrive_whole_and_are_not_sorted_by_slice(spark, tmp_dir, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from logwarden.plans.catalog import _arriving_slices
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda *_: pytest.fail("sorts rows by folder in each task"))
    logs = make_logs(spark, [(f"2024-01-01T{n % 4:02d}:00:00", "INFO", "m", f"E{n}", "a")
                             for n in range(40) if n % 4 != 2]).repartition(3)
    seen = []

    def note(batch, batch_id):
        keys = [int(r.key[1:]) for r in batch.collect()]
        seen.append((batch_id, len(keys), {k % 4 for k in keys}))

    for _, records in _arriving_slices(spark, logs, F.hour("timestamp"), 4):
        records.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(
            availableNow=True).start().awaitTermination()
    assert seen == [(0, 10, {0}), (1, 10, {1}), (2, 10, {3})]        # none for the slice without rows
