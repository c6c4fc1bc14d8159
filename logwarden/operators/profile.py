"""Per-service traffic profile: level mix, gaps between logs, mix rules.

Everything is a single grouped aggregate per service with partial
aggregation, so a service that emits a third of all logs is no hotter than
the others. The mean gap between consecutive logs of a service telescopes to
``(last - first) / (n - 1)``: no ordered window over a whole service is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def _pct(count_col, total_col):
    return F.round(count_col * F.lit(100) / total_col, 2)


def service_level_mix(logs: DataFrame) -> DataFrame:
    """Observed % INFO / WARN / ERROR per service and the difference to the
    target mix."""
    lv = F.col("level")
    agg = logs.groupBy("serviceName").agg(
        F.count(F.lit(1)).alias("total_logs"),
        F.count_if(lv == C.LEVEL_INFO).alias("info_count"),
        F.count_if(lv == C.LEVEL_WARN).alias("warn_count"),
        F.count_if(lv == C.LEVEL_ERROR).alias("error_count"),
    )
    t = F.col("total_logs")
    return agg.select(
        "serviceName", "total_logs", "info_count", "warn_count", "error_count",
        _pct(F.col("info_count"), t).alias("info_pct"),
        _pct(F.col("warn_count"), t).alias("warn_pct"),
        _pct(F.col("error_count"), t).alias("error_pct"),
        F.round(_pct(F.col("info_count"), t) - F.lit(C.TARGET_INFO_RATE), 2).alias("info_diff"),
        F.round(_pct(F.col("warn_count"), t) - F.lit(C.TARGET_WARN_RATE), 2).alias("warn_diff"),
        F.round(_pct(F.col("error_count"), t) - F.lit(C.TARGET_ERROR_RATE), 2).alias("error_diff"),
    )


def _mean_gap():
    span_us = F.unix_micros(F.col("last_seen")) - F.unix_micros(F.col("first_seen"))
    mean_gap = F.when(F.col("timed_logs") > 1,
                      F.round(span_us / F.lit(1000.0) / (F.col("timed_logs") - 1), 3))
    return mean_gap


def service_gaps(logs: DataFrame, active_within: str = "1 hour") -> DataFrame:
    """Mean gap between consecutive logs (ms), first/last seen, and ``active``
    = last log within ``active_within`` of the newest log overall.

    The newest time overall is a one-row aggregate used as a scalar subquery;
    the per-service rows stay distributed.
    """
    ts = F.col("timestamp")
    agg = logs.groupBy("serviceName").agg(
        F.count(ts).alias("timed_logs"),
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"))
    newest = logs.agg(F.max(ts)).scalar()
    active = F.col("last_seen") >= newest - F.expr(f"INTERVAL {active_within}")
    return agg.select(
        "serviceName", F.col("timed_logs").alias("total_logs"), "first_seen", "last_seen",
        _mean_gap().alias("mean_gap_ms"),
        active.alias("active"),
    )


def check_mix_rules(mix: DataFrame) -> DataFrame:
    """Validity of a level-mix configuration: the three rates sum to 100 and
    the delay is at least 1 ms; ``reason`` names the first rule broken."""
    total = F.col("info_rate") + F.col("warn_rate") + F.col("error_rate")
    sum_ok = total == F.lit(C.MIX_TOTAL)
    delay_ok = F.col("delay_ms") >= F.lit(C.MIN_DELAY_MS)
    return mix.select(
        "*",
        total.alias("rate_total"),
        (F.coalesce(sum_ok, F.lit(False)) & F.coalesce(delay_ok, F.lit(False))).alias("valid"),
        F.when(~F.coalesce(sum_ok, F.lit(False)), F.lit("rates must sum to 100"))
         .when(~F.coalesce(delay_ok, F.lit(False)), F.lit("delay must be at least 1 ms"))
         .alias("reason"),
    )


def observed_mix(logs: DataFrame) -> DataFrame:
    """The mix each service actually produced, in configuration form (whole
    percentages by largest remainder, so that the shares of all levels total
    100; mean gap as delay) -- ready for ``check_mix_rules``. One aggregate over
    the logs, no join."""
    lv, ts = F.col("level"), F.col("timestamp")
    agg = logs.groupBy("serviceName").agg(
        F.count(F.lit(1)).alias("total_logs"),
        F.count_if(lv == C.LEVEL_INFO).alias("info_count"),
        F.count_if(lv == C.LEVEL_WARN).alias("warn_count"),
        F.count_if(lv == C.LEVEL_ERROR).alias("error_count"),
        F.count(ts).alias("timed_logs"),
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"))
    t = F.col("total_logs")
    counts = [F.col("info_count"), F.col("warn_count"), F.col("error_count"),
              t - F.col("info_count") - F.col("warn_count") - F.col("error_count")]
    info, warn, error, _ = largest_remainder(counts, t)
    return agg.select(
        "serviceName",
        info.cast("int").alias("info_rate"),
        warn.cast("int").alias("warn_rate"),
        error.cast("int").alias("error_rate"),
        F.round(_mean_gap()).cast("long").alias("delay_ms"),
    )


def largest_remainder(counts: list[Column], total: Column) -> list[Column]:
    """Whole percentages that total 100: each is rounded down, and what is
    missing goes to the largest remainders (the earlier count on a tie)."""
    whole = [F.floor(c * 100 / total) for c in counts]
    rest = [(c * 100) % total for c in counts]
    missing = F.lit(100) - sum(whole[1:], whole[0])
    out = []
    for i, r in enumerate(rest):
        before = sum((F.when((o > r) | ((o == r) & F.lit(j < i)), 1).otherwise(0)
                      for j, o in enumerate(rest) if j != i), F.lit(0))
        out.append(whole[i] + F.when(before < missing, 1).otherwise(0))
    return out
