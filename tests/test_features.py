"""Window features: values, null handling, plan shape, fixture counts."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01, make_logs
from logwarden.operators.features import window_features
from logwarden.sources.fixtures import load_logs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_values_and_nulls(spark):
    logs = make_logs(spark, [
        ("2024-01-01T00:01:00", "ERROR", "abcd", "O-1", "order-service"),
        ("2024-01-01T00:02:00", "INFO", "ab", "O-2", "order-service"),
        ("2024-01-01T00:03:00", "WARN", None, "O-3", "order-service"),
        ("2024-01-01T00:16:00", "ERROR", "x", "O-4", "order-service"),
        ("2024-01-01T00:04:00", "error", None, "C-1", "cart-service"),   # not ERROR
        ("2024-01-01T00:05:00", "ERROR", "zz", "N-1", None),              # null service group
        (None, "ERROR", "dropped", "D-1", "order-service"),               # no timestamp
    ])
    rows = {(r["window_start"].strftime("%H:%M"), r["serviceName"]): r
            for r in window_features(logs, "15 minutes").collect()}
    assert len(rows) == 4
    a = rows[("00:00", "order-service")]
    assert (a["total_logs"], a["error_count"]) == (3, 1)
    assert a["avg_message_length"] == pytest.approx(3.0)      # nulls ignored
    assert a["error_rate"] == 33.33
    assert a["window_end"].strftime("%H:%M") == "00:15"
    c = rows[("00:00", "cart-service")]
    assert c["error_count"] == 0 and c["avg_message_length"] is None
    assert rows[("00:15", "order-service")]["error_rate"] == 100.0
    assert rows[("00:00", None)]["total_logs"] == 1


def test_rate_rounds_half_up(spark):
    # 1 error out of 8 = 12.5 %, 1 of 800 = 0.125 % -> 0.13 (half-up)
    rows = [("2024-01-01T00:00:00", "ERROR", "m", "a", "s")] + \
           [("2024-01-01T00:00:01", "INFO", "m", "b", "s")] * 799
    f = window_features(make_logs(spark, rows), "1 hour").first()
    assert f["error_rate"] == 0.13


def test_plan_one_exchange_pruned_scan(spark):
    f = window_features(load_logs(spark, SF001), "15 minutes")
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan                      # map-side combine
    scan = f._jdf.queryExecution().sparkPlan().toString()
    assert "event_id" not in scan.split("ReadSchema")[1].split("\n")[0]
    assert "value" not in scan.split("ReadSchema")[1].split("\n")[0]


def test_filter_reaches_parquet_scan(spark):
    logs = load_logs(spark, SF001).filter(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp"))
    plan = window_features(logs, "1 hour")._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [IsNotNull(ts)" in plan and "GreaterThanOrEqual(ts" in plan


@pytest.mark.parametrize("sf,window,groups,gt10,rate5,rate15", [
    (SF001, "6 hours", 340, 0, 0, 0),
    (SF001, "1 day", 90, 49, 45, 34),
    (SF01, "15 minutes", 5915, 0, 0, 0),
    (SF01, "1 hour", 2133, 16, 13, 11),
    (SF01, "6 hours", 360, 360, 357, 265),
    (SF01, "1 day", 90, 90, 90, 82),
])
def test_fixture_group_counts(spark, sf, window, groups, gt10, rate5, rate15):
    f = window_features(load_logs(spark, sf), window)
    r = f.agg(F.count(F.lit(1)).alias("n"),
              F.count_if(F.col("total_logs") > 10).alias("a"),
              F.count_if((F.col("total_logs") > 10) & (F.col("error_rate") > 5)).alias("b"),
              F.count_if((F.col("total_logs") > 10) & (F.col("error_rate") > 15)).alias("c")
              ).first()
    assert (r["n"], r["a"], r["b"], r["c"]) == (groups, gt10, rate5, rate15)


def test_output_matches_declared_schemas(spark):
    from logwarden.operators.alerts import alert_records
    from logwarden.operators.scoring import score
    from logwarden.plans.fixed_model import fixed_bundle
    from logwarden.schemas import ALERT_SCHEMA, FEATURE_SCHEMA
    from logwarden.streaming import logs_from_event_files, stream_features

    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    f = window_features(load_logs(spark, SF001), "6 hours")
    assert shape(f.schema) == shape(FEATURE_SCHEMA)
    s = stream_features(logs_from_event_files(spark, f"{SF001}/events*.parquet"), "6 hours")
    assert s.isStreaming and shape(s.schema) == shape(FEATURE_SCHEMA)
    assert shape(alert_records(score(f, fixed_bundle())).schema) == shape(ALERT_SCHEMA)
