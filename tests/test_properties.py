"""Property tests: Spark plans against brute force on random small inputs."""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logwarden.operators.features import window_features
from logwarden.operators.model import ModelBundle
from logwarden.operators.scoring import score
from logwarden.schemas import LOG_SCHEMA

EPOCH = dt.datetime(2024, 1, 1)

log_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 3 * 86400 * 1000)),        # ms offset or null
        st.sampled_from(["INFO", "WARN", "ERROR", "error", None]),
        st.one_of(st.none(), st.text(max_size=12)),
        st.sampled_from(["a", "b", "c", None]),
    ),
    min_size=0, max_size=60)

WINDOWS = {"15 minutes": 900, "1 hour": 3600, "6 hours": 21600}

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _half_up(x, places):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


@SETTINGS
@given(rows=log_rows, window=st.sampled_from(sorted(WINDOWS)))
def test_features_equal_brute_force(spark, rows, window):
    data = [(EPOCH + dt.timedelta(milliseconds=ms) if ms is not None else None,
             lvl, msg, f"id-{i}", svc) for i, (ms, lvl, msg, svc) in enumerate(rows)]
    df = spark.createDataFrame(data, LOG_SCHEMA)
    got = {(r["window_start"], r["serviceName"]):
           (r["total_logs"], r["error_count"], r["avg_message_length"], r["error_rate"])
           for r in window_features(df, window).collect()}
    width = WINDOWS[window]
    groups = defaultdict(list)
    for ts, lvl, msg, _, svc in data:
        if ts is None:
            continue
        secs = int((ts - dt.datetime(1970, 1, 1)).total_seconds())
        start = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=secs - secs % width)
        groups[(start, svc)].append((lvl, msg))
    assert set(got) == set(groups)
    for key, items in groups.items():
        total = len(items)
        errors = sum(1 for lvl, _ in items if lvl == "ERROR")
        lens = [len(m) for _, m in items if m is not None]
        avg = sum(lens) / len(lens) if lens else None
        g = got[key]
        assert g[0] == total and g[1] == errors
        assert (g[2] is None and avg is None) or abs(g[2] - avg) < 1e-9
        assert g[3] == _half_up(errors * 100 / total, 2)


finite = st.floats(-5, 5, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(centers=st.lists(st.lists(finite, min_size=4, max_size=4), min_size=1, max_size=5),
       means=st.lists(st.floats(0, 50), min_size=4, max_size=4),
       stds=st.lists(st.one_of(st.just(0.0), st.floats(0.1, 20)), min_size=4, max_size=4),
       feats=st.lists(st.tuples(st.integers(1, 200), st.integers(0, 200),
                                st.one_of(st.none(), st.floats(0, 40))),
                      min_size=1, max_size=30))
def test_scoring_equals_brute_force(spark, centers, means, stds, feats):
    rows = [(EPOCH, f"s{i}", t, min(e, t), a, round(min(e, t) * 100 / t, 2))
            for i, (t, e, a) in enumerate(feats)]
    df = spark.createDataFrame(rows, "window_start timestamp, serviceName string, "
                                     "total_logs long, error_count long, "
                                     "avg_message_length double, error_rate double")
    bundle = ModelBundle(window="6 hours", means=means, stds=stds, centers=centers)
    got = {r["serviceName"]: r["prediction"] for r in score(df, bundle).collect()}
    for i, (_, svc, t, e, a, rate) in enumerate(rows):
        x = [float(t), float(e), rate, a if a is not None else 0.0]
        z = [(x[j] - means[j]) * (0.0 if stds[j] == 0 else 1.0 / stds[j]) for j in range(4)]
        d = []
        for c in centers:
            acc = None
            for j in range(4):
                term = (z[j] - c[j]) * (z[j] - c[j])
                acc = term if acc is None else acc + term
            d.append(acc)
        assert got[svc] == min(range(len(centers)), key=lambda k: (d[k], k))


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(st.integers(0, 11), max_size=12), min_size=1, max_size=4))
def test_alert_store_holds_each_alert_once(spark, batches):
    import tempfile

    from pyspark.sql import functions as F

    from logwarden.operators.alerts import alert_rows
    from logwarden.sinks.alert_store import insert_alerts, read_alerts

    rows = [(EPOCH + dt.timedelta(days=i % 4, hours=6 * (i % 3)), f"s{i % 5}",
             "HIGH" if i % 2 else "MEDIUM", 20.0 + i) for i in range(12)]
    base = spark.createDataFrame(rows, "window_start timestamp, serviceName string, "
                                       "severity string, error_rate double")
    base = base.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 6 HOURS"))
    store = tempfile.mkdtemp(prefix="lw-prop-", dir="/tmp") + "/store"
    seen = set()
    for picks in batches:                      # overlapping batches, resends included
        part = base.filter(F.col("error_rate").isin([20.0 + i for i in picks]))
        insert_alerts(spark, alert_rows(part), store)
        seen |= set(picks)
    got = sorted(r["metadata"]["errorRate"] for r in read_alerts(spark, store).collect())
    assert got == sorted(20.0 + i for i in seen)
