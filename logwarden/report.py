"""Alert report: the severity counts and the full alert listing of a store.

    python -m logwarden.report --store /shared/alerts [--out /shared/listing]

Counts are one distributed aggregate over the whole store. The listing holds
every alert; executors write it to ``--out`` as CSV files.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators.alerts import alert_listing, severity_counts
from .session import build_session
from .sinks.alert_store import read_alerts


def report(spark: SparkSession, store: str, out: str | None = None) -> dict:
    """Severity counts; with ``out`` the listing is written there too."""
    alerts = read_alerts(spark, store)
    if out is not None:
        alert_listing(alerts).write.mode("overwrite").option("header", "true").csv(out)
    return severity_counts(alerts).first().asDict()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--store", required=True)
    p.add_argument("--out", help="folder for the full listing (CSV)")
    p.add_argument("--master")
    a = p.parse_args(argv)
    c = report(build_session(a.master), a.store, a.out)
    print(f"HIGH {c['high_count']}  MEDIUM {c['medium_count']}  LOW {c['low_count']}")


if __name__ == "__main__":
    main()
