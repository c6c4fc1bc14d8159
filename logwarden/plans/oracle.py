"""DuckDB SQL equivalents of the named queries (the correctness oracle).

Each string runs on DuckDB with the test tables registered as views. The SQL
is written independently of the Spark plans: time buckets by ``time_bucket``
with an explicit epoch origin, percentages rounded on decimals (half-up, as
Spark rounds), the model as literal numbers.
"""

from __future__ import annotations

from .. import constants as C
from ..schemas import VECTOR_COLUMNS
from .catalog import (BAD_TIME_EVERY, JUNK_EVERY, LATE_EVERY, LIST_EVERY, NULL_EVERY, NUMBER_EVERY,
                      REGION_EVERY, REPLAY_SLICES, SILENT_AFTER, UNTIMED_EVERY)
from .fixed_model import FIXED_CENTERS, FIXED_MEANS, FIXED_STDS, FIXED_WINDOW

_SERVICES = C.SERVICE_NAMES

LOGS = f"""
SELECT CAST(ts AS TIMESTAMP) AS "timestamp",
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS level,
       concat_ws(' ', event_type, props) AS message,
       'EVT-' || CAST(event_id AS VARCHAR) AS relatedObjectId,
       CASE user_id % 3 WHEN 0 THEN '{_SERVICES[0]}' WHEN 1 THEN '{_SERVICES[1]}'
                        ELSE '{_SERVICES[2]}' END AS serviceName
FROM events
"""


def _rate(err: str, total: str) -> str:
    return f"CAST(round(CAST({err} * 100 / {total} AS DECIMAL(38, 10)), 2) AS DOUBLE)"


def features(window: str, logs: str = LOGS) -> str:
    return f"""
SELECT window_start, window_start + INTERVAL '{window}' AS window_end, serviceName,
       total_logs, error_count, avg_message_length,
       {_rate('error_count', 'total_logs')} AS error_rate
FROM (
  SELECT time_bucket(INTERVAL '{window}', "timestamp", TIMESTAMP '1970-01-01') AS window_start,
         serviceName,
         count(*) AS total_logs,
         count(CASE WHEN level = 'ERROR' THEN 1 END) AS error_count,
         avg(length(message)) AS avg_message_length
  FROM ({logs}) logs
  WHERE "timestamp" IS NOT NULL
  GROUP BY 1, 2
) g
"""


def _num(x: float) -> str:
    """A DOUBLE literal (exponent form; a plain 1.5 would be a DECIMAL)."""
    return f"{float(x):.17e}"


def _z_exprs(means, stds, src: str = "") -> list[str]:
    out = []
    for i, name in enumerate(VECTOR_COLUMNS):
        x = f"CAST({src}{name} AS DOUBLE)"
        if name == "avg_message_length":
            x = f"coalesce({x}, 0.0)"
        inv = 0.0 if stds[i] == 0 else 1.0 / stds[i]
        out.append(f"(({x} - {_num(means[i])}) * {_num(inv)})")
    return out


def _scored_fixed(logs: str = LOGS) -> str:
    zs = _z_exprs(FIXED_MEANS, FIXED_STDS)
    dists = []
    for c in FIXED_CENTERS:
        terms = [f"(({z} - {_num(ci)}) * ({z} - {_num(ci)}))" for z, ci in zip(zs, c)]
        dists.append(" + ".join(terms))
    d_cols = ",\n       ".join(f"{d} AS d{i}" for i, d in enumerate(dists))
    k = len(FIXED_CENTERS)
    # arg-min with ties to the lower index
    case = "CASE " + " ".join(
        f"WHEN " + " AND ".join(
            [f"d{i} <= d{j}" for j in range(k) if j > i] +
            [f"d{i} < d{j}" for j in range(k) if j < i]) + f" THEN {i}"
        for i in range(k - 1)) + f" ELSE {k - 1} END"
    return f"""
SELECT *, {case} AS prediction
FROM (SELECT *,
       {d_cols}
      FROM ({features(FIXED_WINDOW, logs)}) f) s
"""


def _medium(src: str = "") -> str:
    return (f"({src}prediction = {C.MEDIUM_CLUSTER} AND {src}error_rate > {C.MEDIUM_MIN_ERROR_RATE}"
            f" AND {src}total_logs > {C.MIN_TOTAL_LOGS})")


def _high(src: str = "") -> str:
    return (f"({src}prediction = {C.HIGH_CLUSTER} AND {src}error_rate > {C.HIGH_MIN_ERROR_RATE}"
            f" AND {src}total_logs > {C.MIN_TOTAL_LOGS})")


def _alerts_fixed(logs: str = LOGS) -> str:
    sev = (f"CASE WHEN {_high()} THEN '{C.SEVERITY_HIGH}' "
           f"WHEN {_medium()} THEN '{C.SEVERITY_MEDIUM}' END")
    key = ("CAST(epoch_us(window_start) AS VARCHAR) || '|' || "
           "CAST(epoch_us(window_end) AS VARCHAR) || '|' || "
           "CASE WHEN serviceName IS NULL THEN '' ELSE '=' || serviceName END || '|' || severity")
    return f"""
SELECT CAST(('0x' || substr(sha256({key}), 1, 15)) AS BIGINT) AS id,
       '{C.ALERT_TYPE}' AS type,
       severity,
       '{C.ALERT_SOURCE}' AS source,
       printf('%s servisinde hata oranı: %.2f%%', serviceName, error_rate) AS description,
       serviceName AS meta_service_name,
       error_rate AS meta_error_rate,
       window_start, window_end
FROM (SELECT *, {sev} AS severity FROM ({_scored_fixed(logs)}) s) a
WHERE severity IS NOT NULL
"""


def _scaled() -> str:
    zs = []
    for name in VECTOR_COLUMNS:
        x = f"CAST({name} AS DOUBLE)"
        if name == "avg_message_length":
            x = f"coalesce({x}, 0.0)"
        zs.append(
            f"round(CASE WHEN stddev_samp({x}) OVER () = 0 THEN 0.0 ELSE "
            f"({x} - avg({x}) OVER ()) * (1.0 / stddev_samp({x}) OVER ()) END, 6) AS z_{name}")
    return f"""
SELECT window_start, serviceName, {', '.join(zs)}
FROM ({features(FIXED_WINDOW)}) f
"""


def _scaler_stats() -> str:
    parts = []
    for i, name in enumerate(VECTOR_COLUMNS):
        x = f"CAST({name} AS DOUBLE)"
        if name == "avg_message_length":
            x = f"coalesce({x}, 0.0)"
        parts.append(f"SELECT '{name}' AS feature, {i} AS position, "
                     f"round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std "
                     f"FROM ({features(FIXED_WINDOW)}) f")
    return "\nUNION ALL\n".join(parts)


_ALERT_COLS = ("id, type, severity, source, description, meta_service_name, "
               "meta_error_rate, window_start, window_end")


def _pct(c: str) -> str:
    return f"CAST(round(CAST({c} * 100 / total_logs AS DECIMAL(38, 10)), 2) AS DOUBLE)"


def _level_counts() -> str:
    return f"""
SELECT serviceName, count(*) AS total_logs,
       count(*) FILTER (WHERE level = '{C.LEVEL_INFO}') AS info_count,
       count(*) FILTER (WHERE level = '{C.LEVEL_WARN}') AS warn_count,
       count(*) FILTER (WHERE level = '{C.LEVEL_ERROR}') AS error_count,
       count("timestamp") AS timed_logs,
       min("timestamp") AS first_seen, max("timestamp") AS last_seen
FROM ({LOGS}) logs GROUP BY serviceName
"""


def _mean_gap() -> str:
    return ("CASE WHEN timed_logs > 1 THEN CAST(round(CAST((epoch_us(last_seen) - epoch_us(first_seen))"
            " / 1000.0 / (timed_logs - 1) AS DECIMAL(38, 10)), 3) AS DOUBLE) END")


def _observed_mix() -> str:
    """Largest remainder, by ranking the remainders of each service."""
    return f"""
SELECT m.serviceName,
       CAST(sum(share) FILTER (WHERE place = 1) AS INTEGER) AS info_rate,
       CAST(sum(share) FILTER (WHERE place = 2) AS INTEGER) AS warn_rate,
       CAST(sum(share) FILTER (WHERE place = 3) AS INTEGER) AS error_rate,
       any_value(delay_ms) AS delay_ms
FROM (
  SELECT serviceName, place, delay_ms,
         whole + CASE WHEN row_number() OVER (PARTITION BY serviceName ORDER BY rest DESC, place)
                           <= 100 - sum(whole) OVER (PARTITION BY serviceName)
                      THEN 1 ELSE 0 END AS share
  FROM (
    SELECT serviceName, place, delay_ms, (n * 100) // total_logs AS whole, (n * 100) % total_logs AS rest
    FROM (
      SELECT serviceName, total_logs,
             CAST(round(CAST({_mean_gap()} AS DECIMAL(38, 10)), 0) AS BIGINT) AS delay_ms,
             unnest([1, 2, 3, 4]) AS place,
             unnest([info_count, warn_count, error_count,
                     total_logs - info_count - warn_count - error_count]) AS n
      FROM ({_level_counts()}) c) u) w) m
GROUP BY m.serviceName
"""


def _mix_rules() -> str:
    ok_sum = f"coalesce(info_rate + warn_rate + error_rate = {C.MIX_TOTAL}, false)"
    ok_delay = f"coalesce(delay_ms >= {C.MIN_DELAY_MS}, false)"
    return f"""
SELECT serviceName, info_rate, warn_rate, error_rate, delay_ms,
       info_rate + warn_rate + error_rate AS rate_total,
       {ok_sum} AND {ok_delay} AS valid,
       CASE WHEN NOT {ok_sum} THEN 'rates must sum to 100'
            WHEN NOT {ok_delay} THEN 'delay must be at least 1 ms' END AS reason
FROM ({_observed_mix()}) m
"""


def _malformed() -> str:
    return f"""
SELECT 'EVT-' || CAST(event_id AS VARCHAR) AS key,
       CASE WHEN event_id % {JUNK_EVERY} = 0 THEN 'malformed_json'
            WHEN event_id % {NULL_EVERY} = 0 THEN 'null_value' END AS reason,
       CASE WHEN event_id % {JUNK_EVERY} = 0 OR event_id % {NULL_EVERY} = 0 THEN NULL
            ELSE date_trunc('millisecond', CAST(ts AS TIMESTAMP)) END AS "timestamp",
       CASE WHEN event_id % {JUNK_EVERY} = 0 OR event_id % {NULL_EVERY} = 0 THEN NULL
            ELSE l.level END AS level,
       CASE WHEN event_id % {JUNK_EVERY} = 0 OR event_id % {NULL_EVERY} = 0 THEN NULL
            ELSE l.serviceName END AS serviceName
FROM events e, LATERAL (
  SELECT CASE e.event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS level,
         CASE e.user_id % 3 WHEN 0 THEN '{_SERVICES[0]}' WHEN 1 THEN '{_SERVICES[1]}'
                            ELSE '{_SERVICES[2]}' END AS serviceName) l
"""


def _variant() -> str:
    return f"""
SELECT relatedObjectId AS key, reason,
       CASE WHEN reason IN ('bad_timestamp', 'missing_timestamp') THEN 'timestamp'
            WHEN reason = 'wrong_type' THEN 'level' END AS field,
       CASE WHEN parsed AND n % {BAD_TIME_EVERY} <> 0 AND n % {UNTIMED_EVERY} <> 0
            THEN date_trunc('millisecond', "timestamp") END AS "timestamp",
       CASE WHEN parsed AND n % {NUMBER_EVERY} <> 0 THEN level END AS level,
       CASE WHEN parsed THEN serviceName END AS serviceName,
       CASE WHEN parsed AND n % {REGION_EVERY} = 0 THEN 'region' END AS extra_name,
       CASE WHEN parsed AND n % {REGION_EVERY} = 0 THEN '{{"id":' || n || '}}' END AS region
FROM (
  SELECT *, coalesce(reason NOT IN ('malformed_json', 'null_value', 'not_an_object'), true) AS parsed
  FROM (
    SELECT *, CASE WHEN n % {JUNK_EVERY} = 0 THEN 'malformed_json' WHEN n % {NULL_EVERY} = 0 THEN 'null_value'
                   WHEN n % {LIST_EVERY} = 0 THEN 'not_an_object'
                   WHEN n % {BAD_TIME_EVERY} = 0 THEN 'bad_timestamp'
                   WHEN n % {UNTIMED_EVERY} = 0 THEN 'missing_timestamp'
                   WHEN n % {NUMBER_EVERY} = 0 THEN 'wrong_type' END AS reason
    FROM (SELECT *, CAST(substr(relatedObjectId, 5) AS BIGINT) AS n FROM ({LOGS}) l) m) r) p"""


def _admission() -> str:
    return f"""
SELECT CAST((epoch_us("timestamp") - lo) // step AS INTEGER) AS slice, CAST(1 AS BIGINT) AS batches,
       count(*) AS input_rows, count(*) AS total_logs, true AS triggers_apart
FROM ({LOGS}) l, (
  SELECT min(epoch_us("timestamp")) AS lo, (max(epoch_us("timestamp")) - min(epoch_us("timestamp")))
         // {REPLAY_SLICES} + 1 AS step FROM ({LOGS}) s) b
GROUP BY 1"""


def _insert_times(alerts: str) -> str:
    severities = ", ".join(f"('{s}')" for s in (C.SEVERITY_HIGH, C.SEVERITY_MEDIUM, C.SEVERITY_LOW))
    return f"""
SELECT s.severity, true AS empty_batch_stores_nothing, count(a.id) AS alerts, true AS inserted_in_time
FROM (VALUES {severities}) s(severity) LEFT JOIN ({alerts}) a ON a.severity = s.severity
GROUP BY s.severity"""


def _roundtrip() -> str:
    return f"""
SELECT relatedObjectId AS key, date_trunc('millisecond', "timestamp") AS "timestamp",
       level, message, relatedObjectId, serviceName
FROM ({LOGS}) logs
"""


def _closed_windows() -> str:
    return f"""
SELECT * FROM ({features(FIXED_WINDOW)}) f
WHERE window_end <= (SELECT max(CAST(ts AS TIMESTAMP)) FROM events) - INTERVAL '{FIXED_WINDOW}'
"""


def _gaps() -> str:
    return f"""
SELECT serviceName, timed_logs AS total_logs, first_seen, last_seen,
       {_mean_gap()} AS mean_gap_ms,
       last_seen >= max(last_seen) OVER () - INTERVAL '1 hour' AS active
FROM ({_level_counts()}) c
"""


def _level_mix() -> str:
    return f"""
SELECT serviceName, total_logs, info_count, warn_count, error_count,
       {_pct('info_count')} AS info_pct,
       {_pct('warn_count')} AS warn_pct,
       {_pct('error_count')} AS error_pct,
       round({_pct('info_count')} - {C.TARGET_INFO_RATE}, 2) AS info_diff,
       round({_pct('warn_count')} - {C.TARGET_WARN_RATE}, 2) AS warn_diff,
       round({_pct('error_count')} - {C.TARGET_ERROR_RATE}, 2) AS error_diff
FROM ({_level_counts()}) c
"""


def _late_rows() -> str:
    """Features over the rows of the first arrival and those late rows whose
    window the watermark has not closed."""
    late = f"CAST(substr(relatedObjectId, 5) AS BIGINT) % {LATE_EVERY} = 0"
    start = f"time_bucket(INTERVAL '{FIXED_WINDOW}', \"timestamp\", TIMESTAMP '1970-01-01')"
    newest = f"(SELECT max(\"timestamp\") FROM ({LOGS}) o WHERE NOT ({late}))"
    logs = f"""
SELECT * FROM ({LOGS}) l
WHERE NOT ({late})
   OR {start} + INTERVAL '{FIXED_WINDOW}'
      > date_trunc('millisecond', {newest}) - INTERVAL '{FIXED_WINDOW}'"""
    return features(FIXED_WINDOW, logs)


def _late_accounting() -> str:
    late = f"CAST(substr(relatedObjectId, 5) AS BIGINT) % {LATE_EVERY} = 0"
    end = (f"time_bucket(INTERVAL '{FIXED_WINDOW}', \"timestamp\", TIMESTAMP '1970-01-01')"
           f" + INTERVAL '{FIXED_WINDOW}'")
    return f"""
SELECT serviceName, batch_id, reason, count(*) AS total_logs, min("timestamp") AS first_log,
       max("timestamp") AS last_log
FROM (SELECT serviceName, CAST({late} AS BIGINT) AS batch_id,
             date_trunc('millisecond', "timestamp") AS "timestamp",
             CASE WHEN "timestamp" IS NULL THEN 'missing_timestamp'
                  WHEN {late} AND {end} <= mark THEN 'window_closed' END AS reason
      FROM ({LOGS}) l, (SELECT date_trunc('millisecond', max("timestamp")) - INTERVAL '{FIXED_WINDOW}' AS mark
                        FROM ({LOGS}) o WHERE NOT ({late})) m) r
GROUP BY serviceName, batch_id, reason"""


def _silent_services() -> str:
    """Gaps longer than SILENT_AFTER between neighbouring logs, up to the last
    session that the watermark has closed."""
    return f"""
WITH logs AS (SELECT serviceName, date_trunc('millisecond', "timestamp") AS t FROM ({LOGS}) l
              WHERE "timestamp" IS NOT NULL),
gaps AS (SELECT serviceName, t AS silent_from,
                lead(t) OVER (PARTITION BY serviceName ORDER BY t) AS back_at FROM logs),
ends AS (
  SELECT serviceName, silent_from, back_at,
         lead(silent_from) OVER (PARTITION BY serviceName ORDER BY silent_from) AS next_end
  FROM gaps WHERE back_at IS NULL OR back_at - silent_from > INTERVAL '{SILENT_AFTER}'),
mark AS (SELECT max(t) - INTERVAL '{SILENT_AFTER}' AS m FROM logs)
SELECT serviceName, silent_from,
       CASE WHEN next_end + INTERVAL '{SILENT_AFTER}' <= m THEN back_at END AS back_at
FROM ends, mark WHERE silent_from + INTERVAL '{SILENT_AFTER}' <= m"""


def _state_audit() -> str:
    """After each slice: the windows of all logs so far that end after the
    newest log less the width."""
    parts = []
    for i in range(REPLAY_SLICES):
        so_far = f"""
SELECT * FROM ({LOGS}) l, (
  SELECT min(epoch_us("timestamp")) AS lo, (max(epoch_us("timestamp")) - min(epoch_us("timestamp")))
         // {REPLAY_SLICES} + 1 AS step FROM ({LOGS}) s) b
WHERE (epoch_us("timestamp") - lo) // step <= {i}"""
        parts.append(f"""
SELECT CAST({i} AS INTEGER) AS slice, window_start, window_end, serviceName, total_logs, error_count
FROM ({features(FIXED_WINDOW, so_far)}) f
WHERE window_end > (SELECT date_trunc('millisecond', max("timestamp")) FROM ({so_far}) n) - INTERVAL '{FIXED_WINDOW}'""")
    return " UNION ALL ".join(parts)


def _alerts_replay() -> str:
    """The last gated value of each alert over the cumulative slices."""
    width = f"epoch_us(TIMESTAMP '1970-01-01' + INTERVAL '{FIXED_WINDOW}')"
    place = f"(epoch_us(\"timestamp\") % {width}) // ({width} // {REPLAY_SLICES})"
    parts = [f"SELECT {i} AS slice, a.* FROM ({_alerts_fixed(_until(place, i))}) a"
             for i in range(REPLAY_SLICES)]
    return f"""
SELECT {_ALERT_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, window_end, meta_service_name, severity
                               ORDER BY slice DESC) AS nth
  FROM ({' UNION ALL '.join(parts)}) p) q
WHERE nth = 1"""


def _until(place: str, last: int) -> str:
    return f"SELECT * FROM ({LOGS}) l WHERE {place} <= {last}"


def _kmeans_check() -> str:
    return f"""
SELECT count(*) AS size_sum, CAST({C.KMEANS_K} AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS not_nearest,
       true AS cost_not_above_one_cluster
FROM ({features(FIXED_WINDOW)}) f"""


def oracle_sql() -> dict[str, str]:
    alerts = _alerts_fixed()
    counts = f"""
SELECT count(*) FILTER (WHERE severity = '{C.SEVERITY_HIGH}') AS high_count,
       count(*) FILTER (WHERE severity = '{C.SEVERITY_MEDIUM}') AS medium_count,
       count(*) FILTER (WHERE severity = '{C.SEVERITY_LOW}') AS low_count
FROM ({alerts}) a"""
    return {
        "logs_scan": LOGS,
        "log_level_flags": f"""
SELECT relatedObjectId, level, level = 'ERROR' AS is_error,
       CASE WHEN level = 'ERROR' THEN 1 END AS error_marker,
       length(message) AS message_length
FROM ({LOGS}) logs""",
        "log_record_roundtrip": _roundtrip(),
        "malformed_split": _malformed(),
        "variant_decode": _variant(),
        "variant_failures": f"""
SELECT reason, field, count(*) AS rows, count(extra_name) AS rows_with_extra
FROM ({_variant()}) v GROUP BY reason, field""",
        "window_features_5m": features(C.TRAINING_WINDOW),
        "window_features_15m": features("15 minutes"),
        "window_features_6h": features("6 hours"),
        "window_features_1d": features("1 day"),
        "scaler_stats": _scaler_stats(),
        "scaled_features": _scaled(),
        "centroid_score": f"""
SELECT window_start, window_end, serviceName, total_logs, error_count, error_rate, prediction
FROM ({_scored_fixed()}) s""",
        "alerts_medium": f"""
SELECT window_start, serviceName, total_logs, error_rate, prediction
FROM ({_scored_fixed()}) s WHERE {_medium()}""",
        "alerts_high": f"""
SELECT window_start, serviceName, total_logs, error_rate, prediction
FROM ({_scored_fixed()}) s WHERE {_high()}""",
        "alert_records": alerts,
        "kmeans_check": _kmeans_check(),
        "scaler_stats_by_date": _scaler_stats(),
        "kmeans_coreset_check": f"""
SELECT count(*) AS rows, CAST({C.KMEANS_K} AS BIGINT) AS clusters, true AS cost_within_one_percent
FROM ({features(FIXED_WINDOW)}) f""",
        "model_reuse_alerts": alerts,
        "alert_listing": f"""
SELECT id, strftime(window_start, '%d.%m.%Y %H:%M:%S') AS time, type, severity, source,
       description
FROM ({alerts}) a""",
        "severity_counts": counts,
        "alert_insert_times": _insert_times(alerts),
        "severity_counts_by_date": counts,
        "alert_topic_rows": f"SELECT CAST(id AS VARCHAR) AS key, {_ALERT_COLS} FROM ({alerts}) a",
        "stream_features_update": features(FIXED_WINDOW),
        "stream_features_append": _closed_windows(),
        "alert_store_compacted": alerts,
        "stream_alerts": alerts,
        "stream_alerts_append": f"""
SELECT * FROM ({alerts}) a
WHERE window_end <= (SELECT max(CAST(ts AS TIMESTAMP)) FROM events) - INTERVAL '{FIXED_WINDOW}'""",
        "stream_topic_replay": features(FIXED_WINDOW),
        "stream_late_rows": _late_rows(),
        "stream_alerts_replay": _alerts_replay(),
        "stream_alerts_withdrawn": alerts,
        "stream_silent_services": _silent_services(),
        "stream_late_accounting": _late_accounting(),
        "stream_state_audit": _state_audit(),
        "stream_admission": _admission(),
        "training_snapshot": LOGS,
        "service_level_mix": _level_mix(),
        "service_gaps": _gaps(),
        "mix_rule_check": _mix_rules(),
    }
