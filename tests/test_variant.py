"""Records decoded to VARIANT: reasons, failing fields, unknown fields."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import make_logs
from logwarden.schemas import LOG_COLUMNS
from logwarden.sources import decode_logs, encode_logs
from logwarden.sources.variant import decode_variant, extra_text, failure_counts

TIME = "2024-01-01T00:00:00.123"


def records(spark, values):
    pairs = [(str(i).encode(), v.encode() if isinstance(v, str) else v) for i, v in enumerate(values)]
    return spark.createDataFrame(pairs, "key binary, value binary")


def decoded(spark, values):
    rows = decode_variant(records(spark, values)).select(
        F.col("key").cast("string").cast("int").alias("i"), *LOG_COLUMNS, "reason", "field",
        F.sort_array(F.map_keys("extra")).alias("names"), extra_text("region").alias("region")).collect()
    return {r.i: r for r in rows}


@pytest.mark.parametrize("value, reason, field", [
    (None, "null_value", None),
    ("", "malformed_json", None),
    ("not json", "malformed_json", None),
    ('{"level":"INFO"', "malformed_json", None),
    ('{"level":"INFO","level":"WARN"}', "malformed_json", None),
    ("[1,2]", "not_an_object", None),
    ("null", "not_an_object", None),
    ("5", "not_an_object", None),
    ("{}", "missing_timestamp", "timestamp"),
    ('{"timestamp":null}', "missing_timestamp", "timestamp"),
    ('{"timestamp":"yesterday","level":5}', "bad_timestamp", "timestamp"),
    ('{"timestamp":1704067200}', "bad_timestamp", "timestamp"),
    (json.dumps({"timestamp": TIME, "level": 5, "serviceName": []}), "wrong_type", "level"),
    (json.dumps({"timestamp": TIME, "serviceName": {"a": 1}}), "wrong_type", "serviceName"),
    (json.dumps({"timestamp": TIME, "message": None}), None, None),
    (json.dumps({"timestamp": TIME, "Level": 5}), None, None),
])
def test_reason_and_field(spark, value, reason, field):
    r = decoded(spark, [value])[0]
    assert (r.reason, r.field) == (reason, field)


def test_other_fields_survive_a_bad_one_and_unknown_fields_are_kept(spark):
    out = decoded(spark, [
        json.dumps({"timestamp": "bad", "level": "ERROR", "region": "eu"}),
        json.dumps({"timestamp": TIME, "level": 1, "message": "m", "region": {"id": 7}, "z": [1]}),
        json.dumps({"timestamp": TIME, "level": "INFO", "region": None})])
    assert out[0].level == "ERROR" and out[0].timestamp is None and out[0].region == '"eu"'
    assert out[1].level is None and out[1].message == "m" and out[1].region == '{"id":7}'
    assert out[1].names == ["region", "z"]
    assert out[2].reason is None and out[2].names == ["region"]


def test_agrees_with_the_fixed_schema_on_good_records(spark):
    logs = make_logs(spark, [("2024-01-01T10:00:00.123456", "ERROR", "bo\"om: ü", "ORD-1", "a"),
                             ("2024-01-01T10:00:01", None, None, None, None),
                             ("2024-01-01T10:00:01", "INFO", "", "", "")])
    rec = encode_logs(logs)
    assert (sorted(map(tuple, decode_logs(rec).collect()), key=str)
            == sorted(map(tuple, decode_variant(rec).select(*LOG_COLUMNS).collect()), key=str))


def test_counts_empty_table_repeats_and_columns_of_clashing_names(spark):
    good = json.dumps({"timestamp": TIME, "level": "INFO", "x": 1})
    rows = failure_counts(decode_variant(records(spark, [good, good, None, "[]"]))).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(None, None, 2, 2), ("null_value", None, 1, 0), ("not_an_object", None, 1, 0)], key=str)
    assert decode_variant(records(spark, []).limit(0)).count() == 0
    clash = records(spark, [good]).withColumns({c: F.lit("other") for c in ("level", "reason", "extra", "_fields")})
    r = decode_variant(clash).first()
    assert r.level == "INFO" and r.reason is None
    assert decode_variant(records(spark, [good]).drop("key")).columns[0] == "timestamp"


def test_the_text_is_parsed_once(spark):
    df = decode_variant(records(spark, ["{}"])).filter(F.col("timestamp").isNotNull() & F.col("reason").isNull())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1
