"""Log records decoded to VARIANT: parsed once, unknown fields kept, the failing
field named.

``decode_logs`` keeps the fields of the fixed schema only and turns whatever
does not fit into nulls. Here the whole value becomes a VARIANT, so fields that
producers add later survive, and a record that does not fit says why and where.
Everything is built-in expressions on the JVM; the parse is flattened through a
generator for the reason given in ``codec``.

Defined results: text fields must be JSON strings (``wrong_type`` otherwise,
unlike ``from_json``, which prints numbers and objects into them); JSON null is
an absent field; a record with one field name twice is malformed, as VARIANT
objects have unique names; what follows the first JSON value is not read; a
value that is JSON but no object (``[1]``, ``5``) is ``not_an_object``; field
names are matched exactly; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..schemas import LOG_COLUMNS
from .codec import value_text

TIME_FIELD = "timestamp"
TEXT_FIELDS = [c for c in LOG_COLUMNS if c != TIME_FIELD]

NULL_VALUE, MALFORMED, NO_OBJECT = "null_value", "malformed_json", "not_an_object"
MISSING_TIME, BAD_TIME, WRONG_TYPE = "missing_timestamp", "bad_timestamp", "wrong_type"


def _member(name: str) -> Column:
    """A field of the record; null where it is absent or JSON null."""
    v = F.col("_fields")[name]
    return F.when(~F.is_variant_null(v), v)


def _text(name: str) -> Column:
    """A field's text if it is a JSON string."""
    v = F.col("_" + name)
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _unfold(df: DataFrame, keep: list[str], columns: list[Column]) -> DataFrame:
    """``columns`` worked out once: nothing is substituted through a generator."""
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def _first(conditions: list[tuple[Column, str | None]]) -> Column:
    """The text that goes with the first condition that holds."""
    (when, text), *rest = conditions
    return reduce(lambda c, p: c.when(p[0], F.lit(p[1])), rest,
                  F.when(when, F.lit(text).cast("string")))


def decode_variant(records: DataFrame, value: str = "value",
                   keep: tuple[str, ...] = ("key",)) -> DataFrame:
    """The log columns, ``reason`` and ``field`` (null for a usable row), and
    ``extra``: a map of the unknown fields as VARIANT (null if nothing parsed).

    ``reason``: ``null_value``, ``malformed_json``, ``not_an_object``,
    ``missing_timestamp`` / ``bad_timestamp`` (field: the time stamp) or
    ``wrong_type`` (field: the first such text field in schema order). A field
    that does not fit is null; the others are kept."""
    kept = [k for k in keep if k in records.columns]
    raw = value_text(value)
    parsed = _unfold(records, kept, [raw.alias("_raw"), F.try_parse_json(raw).alias("_value")])
    # Only an object casts to a map, so null here is any other JSON value.
    opened = _unfold(parsed, [*kept, "_raw", "_value"],
                     [F.try_variant_get("_value", "$", "map<string,variant>").alias("_fields")])
    members = _unfold(opened, [*kept, "_raw", "_value", "_fields"],
                      [_member(c).alias("_" + c) for c in LOG_COLUMNS])
    stamp = F.try_to_timestamp(_text(TIME_FIELD), F.lit(C.WIRE_TIME_FORMAT))
    typed = _unfold(members, [*kept, "_raw", "_value", "_fields", *["_" + c for c in LOG_COLUMNS]],
                    [stamp.alias(TIME_FIELD), *[_text(c).alias(c) for c in TEXT_FIELDS]])
    broken = [(F.col("_raw").isNull(), NULL_VALUE), (F.col("_value").isNull(), MALFORMED),
              (F.col("_fields").isNull(), NO_OBJECT)]
    faults = [(F.col("_" + TIME_FIELD).isNull(), MISSING_TIME, TIME_FIELD),
              (F.col(TIME_FIELD).isNull(), BAD_TIME, TIME_FIELD),
              *[(F.col("_" + c).isNotNull() & F.col(c).isNull(), WRONG_TYPE, c) for c in TEXT_FIELDS]]
    known = F.array(*map(F.lit, LOG_COLUMNS))
    return typed.select(
        *kept, *LOG_COLUMNS,
        _first([*broken, *[(when, name) for when, name, _ in faults]]).alias("reason"),
        _first([*[(when, None) for when, _ in broken],
                *[(when, field) for when, _, field in faults]]).alias("field"),
        F.map_filter("_fields", lambda k, _: ~F.array_contains(known, k)).alias("extra"))


def extra_text(name: str) -> Column:
    """An unknown field of a decoded row as JSON text."""
    return F.to_json(F.col("extra")[name])


def failure_counts(decoded: DataFrame) -> DataFrame:
    """Rows by reason and field (usable rows: null, null), and how many of them
    carry unknown fields. One aggregate with partial counts per task."""
    return decoded.groupBy("reason", "field").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size("extra") > 0).alias("rows_with_extra"))
