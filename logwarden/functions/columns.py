"""Column expressions shared by batch and streaming plans.

All of them are built-in Catalyst expressions, so they stay inside whole-stage
code generation; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_error(level: str | Column = "level") -> Column:
    """``level = 'ERROR'`` (anything else, null included, is not an error)."""
    return _c(level) == F.lit(C.LEVEL_ERROR)


def error_marker(level: str | Column = "level") -> Column:
    """``when(level = 'ERROR', 1)``: 1 for errors, null otherwise."""
    return F.when(is_error(level), F.lit(1))


def message_length(message: str | Column = "message") -> Column:
    """Length in characters; null for a null message."""
    return F.length(_c(message))


def error_rate(error_count: str | Column = "error_count",
               total_logs: str | Column = "total_logs") -> Column:
    """Percentage of errors, rounded half-up to 2 decimals (double division)."""
    return F.round(_c(error_count) * F.lit(100) / _c(total_logs), 2)


def alert_description(service: str | Column = "serviceName",
                      rate: str | Column = "error_rate") -> Column:
    return F.format_string(C.ALERT_DESCRIPTION_FORMAT, _c(service), _c(rate))


def alert_metadata(service: str | Column = "serviceName",
                   rate: str | Column = "error_rate") -> Column:
    """Typed metadata; ``to_json`` of it keeps the rate a JSON number."""
    return F.struct(_c(service).alias("serviceName"),
                    _c(rate).cast("double").alias("errorRate"))


def alert_key(window_start: str | Column, window_end: str | Column,
              service: str | Column, severity: str | Column) -> Column:
    """Natural key of an alert: one per window, service and severity.

    Window bounds enter as epoch microseconds, which do not depend on the
    session time zone: jobs running in different zones agree on every id."""
    return F.concat_ws(
        "|",
        F.unix_micros(_c(window_start)).cast("string"),
        F.unix_micros(_c(window_end)).cast("string"),
        F.coalesce(F.concat(F.lit("="), _c(service)), F.lit("")),   # null is not ""
        _c(severity),
    )


def alert_id(window_start: str | Column = "window_start",
             window_end: str | Column = "window_end",
             service: str | Column = "serviceName",
             severity: str | Column = "severity") -> Column:
    """Deterministic 60-bit id from the alert key (first 15 hex digits of
    SHA-256). Re-sending the same alert yields the same id, which makes the
    store insert idempotent."""
    digest = F.sha2(alert_key(window_start, window_end, service, severity), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(duration: str) -> int:
    """Length of a window width such as "15 minutes" or "1 hour 30 minutes"."""
    parts = duration.lower().removeprefix("interval").replace("'", " ").split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for number, unit in zip(parts[::2], parts[1::2]):
        unit = unit.rstrip("s")
        if unit not in _UNIT_SECONDS or not number.isdigit():
            raise ValueError(f"not a duration: {duration!r}")
        total += int(number) * _UNIT_SECONDS[unit]
    return total


def display_time(ts: str | Column = "timestamp") -> Column:
    """Listing format of a time stamp."""
    return F.date_format(_c(ts), C.ALERT_TIME_DISPLAY_FORMAT)
