"""Sources and codec: topic scan, JSON decoding, malformed rows, encoding."""

import pytest
from pyspark.sql import functions as F

from conftest import make_logs
from logwarden.schemas import LOG_COLUMNS
from logwarden.sinks.topic import publish_records
from logwarden.sources import (classify_records, decode_logs, encode_logs, read_topic,
                               read_topic_stream, split_malformed)


def _records(spark, pairs):
    return spark.createDataFrame(pairs, "key binary, value binary")


def test_encode_decode_roundtrip_truncates_to_ms(spark):
    logs = make_logs(spark, [
        ("2024-01-01T10:00:00.123456", "ERROR", "boom: ORD-1", "ORD-1", "order-service"),
        ("2024-01-01T10:00:01", "INFO", None, "CART-2", "cart-service"),
    ])
    rec = encode_logs(logs)
    assert rec.columns == ["key", "value", "topic"]
    text = [r[0] for r in rec.select(F.col("value").cast("string")).collect()]
    assert '"timestamp":"2024-01-01T10:00:00.123"' in text[0]
    back = decode_logs(rec).orderBy("relatedObjectId").collect()
    assert back[0]["relatedObjectId"] == "CART-2" and back[0]["message"] is None
    assert back[1]["timestamp"].microsecond == 123000
    assert [r["key"] for r in rec.select(F.col("key").cast("string").alias("key"))
            .orderBy("key").collect()] == ["CART-2", "ORD-1"]


def test_malformed_rows_become_nulls_and_are_classified(spark):
    pairs = [
        (b"a", b"this is not json"),
        (b"b", None),
        (b"c", b'{"level":"ERROR","message":"m","serviceName":"s"}'),
        (b"d", b'{"timestamp":"yesterday","level":"ERROR","message":"m","serviceName":"s"}'),
        (b"e", b'{"timestamp":"2024-01-01T00:00:00.000","level":"INFO","serviceName":"s"}'),
        (b"f", b'{"timestamp":"2024-01-01T00:00:00.000","level":"INFO","message":"m"}'),
    ]
    out = {r["key"].decode(): r for r in classify_records(_records(spark, pairs)).collect()}
    assert out["a"]["reason"] == "malformed_json"
    assert all(out["a"][c] is None for c in LOG_COLUMNS)
    assert out["b"]["reason"] == "null_value"
    assert out["c"]["reason"] == "missing_timestamp" and out["c"]["level"] == "ERROR"
    # an unparsable time stamp nulls that field only
    assert out["d"]["reason"] == "missing_timestamp" and out["d"]["serviceName"] == "s"
    assert out["e"]["reason"] is None and out["e"]["message"] is None
    assert out["f"]["reason"] is None and out["f"]["serviceName"] is None
    good, bad = split_malformed(_records(spark, pairs))
    assert good.count() == 2 and bad.count() == 4
    # PERMISSIVE: plain decoding never fails, bad rows are all-null rows
    assert decode_logs(_records(spark, pairs)).count() == 6


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_topic_files_batch_scan_reads_everything(spark, tmp_dir, fmt):
    logs = make_logs(spark, [(f"2024-01-01T00:00:{i:02d}", "INFO", f"m{i}", f"ORD-{i}",
                              "order-service") for i in range(50)])
    publish_records(encode_logs(logs), path=f"{tmp_dir}/t", fmt=fmt)
    rec = read_topic(spark, path=f"{tmp_dir}/t", fmt=fmt)
    # no cap in batch: all 50 records, whatever rate options exist for streams
    assert rec.count() == 50
    assert decode_logs(rec).filter(F.col("timestamp").isNull()).count() == 0


def test_topic_stream_rate_limit_per_trigger(spark, tmp_dir):
    import os
    for i in range(3):
        logs = make_logs(spark, [(f"2024-01-01T00:0{i}:00", "INFO", "m", f"ORD-{i}",
                                  "order-service")])
        encode_logs(logs).write.parquet(os.path.join(tmp_dir, "in", f"part{i}"))
    stream = read_topic_stream(spark, path=os.path.join(tmp_dir, "in", "*"),
                               schema="key binary, value binary, topic string",
                               max_files_per_trigger=1)
    q = (decode_logs(stream).writeStream.format("memory").queryName("rate_limited")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    assert batches == [1, 1, 1]
    assert spark.table("rate_limited").count() == 3


def test_field_order_and_unknown_fields_do_not_matter(spark):
    pairs = [(b"k", b'{"serviceName":"s","extra":{"a":1},"message":"hi","level":"ERROR",'
                    b'"timestamp":"2024-01-01T10:00:00.250","relatedObjectId":"X-1","n":3}')]
    r = decode_logs(_records(spark, pairs)).first()
    assert (r["serviceName"], r["message"], r["level"], r["relatedObjectId"]) == \
        ("s", "hi", "ERROR", "X-1")
    assert r["timestamp"].isoformat() == "2024-01-01T10:00:00.250000"
