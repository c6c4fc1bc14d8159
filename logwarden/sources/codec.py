"""Log record codec: JSON value <-> typed log columns.

Decoding is ``from_json`` in PERMISSIVE mode against the fixed schema, so bad
input never fails a job: a null value or broken JSON gives a row of nulls, and
a bad field nulls that field. ``classify_records`` names the reason so callers
can split good from bad rows in one pass.

The parsed struct is flattened through a generator (``inline`` of a one-element
array). A plain ``select("log.*")`` would let the optimizer push later filters
-- the null-time filter every window aggregate adds, or a good/bad split --
below the projection by substituting the ``from_json`` call, so each record
would be parsed twice; filters cannot pass a generator, so it is parsed once.
JSON parsing is the dominant per-record cost of the whole pipeline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..schemas import LOG_COLUMNS, LOG_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"

_OPTIONS = {"mode": "PERMISSIVE", "timestampFormat": C.WIRE_TIME_FORMAT}
_CHECKED_OPTIONS = dict(_OPTIONS, columnNameOfCorruptRecord=CORRUPT_COLUMN)
_CHECKED_SCHEMA = T.StructType(list(LOG_SCHEMA.fields)
                               + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


def value_text(value: str | Column = "value") -> Column:
    """Binary record value as UTF-8 text."""
    v = F.col(value) if isinstance(value, str) else value
    return v.cast("string")


def parse_log(json_text: Column, keep_corrupt: bool = False,
              fields: tuple[str, ...] | None = None) -> Column:
    """Struct of the log fields from JSON (only ``fields`` if given); with
    ``keep_corrupt`` also the raw text of records that did not parse cleanly."""
    if keep_corrupt:
        return F.from_json(json_text, _CHECKED_SCHEMA, _CHECKED_OPTIONS)
    schema = LOG_SCHEMA if fields is None else T.StructType(
        [f for f in LOG_SCHEMA.fields if f.name in fields])
    return F.from_json(json_text, schema, _OPTIONS)


def _flatten_once(struct: Column) -> Column:
    return F.inline(F.array(struct))


def decode_logs(records: DataFrame, value: str = "value",
                keep: tuple[str, ...] = (),
                fields: tuple[str, ...] | None = None) -> DataFrame:
    """``CAST(value AS STRING)`` -> ``from_json`` -> the log columns (``keep``
    names source columns to carry along, e.g. the key). ``fields`` limits the
    JSON fields that are parsed: the optimizer cannot prune them through the
    generator, so a plan that needs few of them says so."""
    return records.select(*keep, _flatten_once(parse_log(value_text(value), fields=fields)))


def classify_records(records: DataFrame, value: str = "value",
                     keep: tuple[str, ...] = ("key",)) -> DataFrame:
    """Decoded log columns plus ``reason``: null for a usable row, else one of
    ``null_value``, ``malformed_json`` (nothing parsed), ``missing_timestamp``
    (absent or unparsable time stamp; the other fields are kept).

    Rows without a time stamp are exactly those the windowed aggregate drops.
    """
    text = value_text(value)
    kept = [k for k in keep if k in records.columns]
    parsed = records.select(*kept, text.alias("_text"),
                            _flatten_once(parse_log(text, keep_corrupt=True)))
    all_null = None
    for c in LOG_COLUMNS:
        t = F.col(c).isNull()
        all_null = t if all_null is None else (all_null & t)
    reason = (F.when(F.col("_text").isNull(), F.lit("null_value"))
              .when(F.col(CORRUPT_COLUMN).isNotNull() & all_null, F.lit("malformed_json"))
              .when(F.col("timestamp").isNull(), F.lit("missing_timestamp")))
    return parsed.select(*kept, *LOG_COLUMNS, reason.alias("reason"))


def split_malformed(records: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, bad) views of one classification; persist the input first if both
    are consumed."""
    classified = classify_records(records, value)
    good = classified.filter(F.col("reason").isNull()).drop("reason")
    bad = classified.filter(F.col("reason").isNotNull())
    return good, bad


def encode_logs(logs: DataFrame, topic: str | None = C.LOGS_TOPIC,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Log rows -> topic records: key = relatedObjectId, value = JSON with a
    millisecond wire time stamp. Ready for ``write.format("kafka")`` or files.
    ``keep`` names further columns to carry along."""
    value = F.to_json(F.struct(*[F.col(c) for c in LOG_COLUMNS]),
                      {"timestampFormat": C.WIRE_TIME_FORMAT})
    cols = [F.col("relatedObjectId").cast("binary").alias("key"),
            value.cast("binary").alias("value")]
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    return logs.select(*cols, *keep)
