"""Alert gates, records, listing, counts, idempotent store, topic."""

import json

from pyspark.sql import functions as F

from logwarden.operators.alerts import (alert_listing, alert_records, gated, high_risk,
                                        medium_risk, severity_counts)
from logwarden.schemas import ALERT_COLUMNS
from logwarden.sinks.alert_store import insert_alerts, read_alerts
from logwarden.sinks.topic import alert_publisher, decode_alert_records
from logwarden.sources.topic import read_topic


def _edge_rows(spark):
    """F3 edge rows: totals 10/11 x rates 5.0/5.01/15.0/15.01 x clusters 0..2."""
    rows = []
    i = 0
    for total in (10, 11):
        for rate in (5.0, 5.01, 15.0, 15.01):
            for cluster in (0, 1, 2):
                rows.append((f"2024-01-0{1 + i % 5}T00:00:00", f"svc-{i}", total, rate, cluster))
                i += 1
    df = spark.createDataFrame(rows, "ws string, serviceName string, total_logs long, "
                                     "error_rate double, prediction int")
    return df.select(F.col("ws").cast("timestamp").alias("window_start"),
                     (F.col("ws").cast("timestamp") + F.expr("INTERVAL 6 HOURS")).alias("window_end"),
                     "serviceName", "total_logs", F.lit(0).cast("long").alias("error_count"),
                     F.lit(10.0).alias("avg_message_length"), "error_rate", "prediction")


def test_gates_are_strict(spark):
    df = _edge_rows(spark)
    med = {(r["total_logs"], r["error_rate"]) for r in medium_risk(df).collect()}
    high = {(r["total_logs"], r["error_rate"]) for r in high_risk(df).collect()}
    assert med == {(11, 5.01), (11, 15.0), (11, 15.01)}
    assert high == {(11, 15.01)}
    assert all(r["prediction"] == 1 for r in medium_risk(df).collect())
    assert gated(df).count() == 4


def test_alert_record_fields(spark):
    a = alert_records(_edge_rows(spark)).filter("severity = 'HIGH'").first()
    assert a["type"] == "HIGH_ERROR_RATE" and a["source"] == "anomaly-detector"
    assert a["description"] == f"{a['metadata']['serviceName']} servisinde hata oranı: 15.01%"
    assert a["metadata"]["errorRate"] == 15.01
    wire = json.loads(alert_records(_edge_rows(spark)).filter("severity = 'HIGH'")
                      .select(F.to_json("metadata")).first()[0])
    assert wire["errorRate"] == 15.01           # a JSON number, not a string
    assert alert_records(_edge_rows(spark)).columns == ALERT_COLUMNS


def test_id_is_deterministic_and_ignores_insert_time(spark):
    df = _edge_rows(spark)
    a = alert_records(df, now=F.lit("2020-01-01 00:00:00").cast("timestamp"))
    b = alert_records(df, now=F.lit("2030-01-01 00:00:00").cast("timestamp"))
    ids_a = sorted(r["id"] for r in a.collect())
    assert ids_a == sorted(r["id"] for r in b.collect())
    assert len(set(ids_a)) == len(ids_a) and all(i >= 0 for i in ids_a)
    t = alert_records(df).select("timestamp").first()[0]
    assert t is not None


def test_listing_and_counts(spark):
    df = _edge_rows(spark)
    alerts = alert_records(df, now=F.lit("2024-03-05 07:08:09").cast("timestamp"))
    lst = alert_listing(alerts).collect()
    assert lst[0]["time"] == "05.03.2024 07:08:09"
    assert alert_listing(alerts).columns == ["id", "time", "type", "severity", "source",
                                             "description"]
    extra = spark.createDataFrame([("LOW",), ("LOW",), ("other",), (None,)], "severity string")
    c = severity_counts(alerts.select("severity").unionByName(extra)).first()
    assert (c["high_count"], c["medium_count"], c["low_count"]) == (1, 3, 2)
    z = severity_counts(spark.createDataFrame([], "severity string")).first()
    assert (z["high_count"], z["medium_count"], z["low_count"]) == (0, 0, 0)


def test_store_insert_is_idempotent(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    assert read_alerts(spark, store).count() == 0           # missing store -> empty
    assert read_alerts(spark, store).columns == ALERT_COLUMNS
    alerts = alert_records(_edge_rows(spark))
    insert_alerts(spark, alerts, store)
    insert_alerts(spark, alerts, store)
    insert_alerts(spark, alerts.unionByName(alerts), store)
    got = read_alerts(spark, store)
    assert got.count() == 4
    assert got.select("id").distinct().count() == 4


def test_publish_new_alerts_to_topic(spark, tmp_dir):
    store, topic = f"{tmp_dir}/store", f"{tmp_dir}/topic"
    alerts = alert_records(_edge_rows(spark))
    insert_alerts(spark, alerts, store, publish=alert_publisher(path=topic))
    insert_alerts(spark, alerts, store, publish=alert_publisher(path=topic))
    rec = decode_alert_records(read_topic(spark, path=topic))
    assert rec.count() == 4                     # the resend published nothing
    r = rec.filter("severity = 'HIGH'").first()
    assert r["key"] == str(r["id"]) and r["metadata"]["errorRate"] == 15.01


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_dir):
    import glob
    from logwarden.sinks.alert_store import compact_alerts
    store = f"{tmp_dir}/store"
    alerts = alert_records(_edge_rows(spark))
    for sev in ("HIGH", "MEDIUM"):                 # two appends -> several files per date
        insert_alerts(spark, alerts.filter(F.col("severity") == sev), store)
    before = sorted((r["id"], r["severity"]) for r in read_alerts(spark, store).collect())
    files_before = len(glob.glob(f"{store}/window_date=*/*.parquet"))
    compact_alerts(spark, store, "2024-01-04")
    after = sorted((r["id"], r["severity"]) for r in read_alerts(spark, store).collect())
    assert after == before
    for d in glob.glob(f"{store}/window_date=2024-01-0[1-3]"):
        assert len(glob.glob(f"{d}/*.parquet")) <= 1
    assert len(glob.glob(f"{store}/window_date=*/*.parquet")) <= files_before
    insert_alerts(spark, alerts, store)            # still idempotent after compaction
    assert read_alerts(spark, store).count() == 4


def test_alert_id_does_not_depend_on_session_time_zone(spark):
    df = _edge_rows(spark)
    before = sorted(r["id"] for r in alert_records(df).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = sorted(r["id"] for r in alert_records(df).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == before


def test_inserts_from_sessions_in_other_zones_do_not_duplicate(spark, tmp_dir):
    """Windows late in the UTC day fall on the next calendar day in Tokyo; the
    store's date must not follow the session zone, or a resend from a Tokyo
    job would be filed under another date and stored twice."""
    store = f"{tmp_dir}/store"
    late = (_edge_rows(spark)
            .withColumn("window_start", F.col("window_start") + F.expr("INTERVAL 20 HOURS"))
            .withColumn("window_end", F.col("window_end") + F.expr("INTERVAL 20 HOURS")))
    alerts = alert_records(late)                 # analysed (times fixed) under UTC
    insert_alerts(spark, alerts, store)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        insert_alerts(spark, alerts, store)
        n_tokyo = read_alerts(spark, store).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert n_tokyo == read_alerts(spark, store).count() == 4
