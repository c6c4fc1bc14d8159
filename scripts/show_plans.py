"""Print the final (post-AQE) physical plans of the key operators.

    python scripts/show_plans.py [sf_dir] > PLANS.md

Each plan is taken after the query ran (``collect``), so AQE decisions
(coalesced shuffles, broadcast choices) are the real ones.
"""

from __future__ import annotations

import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from logwarden.operators.alerts import alert_records
    from logwarden.operators.features import window_features
    from logwarden.operators.profile import observed_mix, service_gaps
    from logwarden.operators.scoring import score
    from logwarden.plans.fixed_model import fixed_bundle
    from logwarden.session import build_session
    from logwarden.sinks.topic import publish_records
    from logwarden.sources.codec import classify_records, decode_logs, encode_logs
    from logwarden.sources.fixtures import load_logs
    from logwarden.sources.topic import read_topic

    spark = build_session("local[8]", 8, app_name="logwarden-plans",
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="plans-",
                                                                          dir="/tmp")})
    logs = load_logs(spark, sf_dir)
    topic = tempfile.mkdtemp(prefix="plans-topic-", dir="/tmp") + "/t"
    publish_records(encode_logs(logs), path=topic)
    records = read_topic(spark, path=topic)

    plans = {
        "window features (15 minutes) over parquet logs": window_features(logs, "15 minutes"),
        "window features over decoded topic records": window_features(decode_logs(records),
                                                                      "15 minutes"),
        "malformed-record classification": classify_records(records),
        "alerts: features -> expression scoring -> gated alert rows":
            alert_records(score(window_features(logs, "6 hours"), fixed_bundle())),
        "service gaps (R2)": service_gaps(logs),
        "observed mix (R3 input)": observed_mix(logs),
    }
    from logwarden.plans.fixed_model import FIXED_WINDOW
    from logwarden.sinks.alert_store import insert_alerts, read_alerts
    from logwarden.streaming import (current_features, fold_changelog, run_until_idle,
                                     start_detection, start_feature_changelog, stream_features)
    from logwarden.sources.topic import read_topic_stream
    from logwarden.session import scratch_path

    store, log, table = (scratch_path(spark, n) for n in ("store", "log", "table"))
    insert_alerts(spark, plans["alerts: features -> expression scoring -> gated alert rows"], store)
    plans["alert store: last value per alert"] = read_alerts(spark, store)
    stream = decode_logs(read_topic_stream(spark, path=topic))
    changes = start_feature_changelog(stream_features(stream, FIXED_WINDOW), log,
                                      scratch_path(spark, "ckpt"), {"availableNow": True})
    run_until_idle(changes)
    fold_changelog(spark, log, table)
    plans["current features: folded dates + recent batches"] = current_features(spark, log, table)
    detection = start_detection(stream, fixed_bundle(), store, scratch_path(spark, "ckpt"),
                                {"availableNow": True})
    run_until_idle(detection)
    print("# Physical plans (final, after AQE)\n")
    print(f"Generated by `scripts/show_plans.py {sf_dir}`.\n")
    for title, df in plans.items():
        df.collect()
        print(f"## {title}\n")
        print("```")
        print(df._jdf.queryExecution().executedPlan().toString().rstrip())
        print("```\n")
    for title, query in (("feature stream (last batch)", changes),
                         ("detection stream (last batch)", detection)):
        print(f"## {title}\n")
        print("```")
        print(query._jsq.explainInternal(False).rstrip())
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
