"""Task failures (as when an executor is lost) are retried by Spark; the
alert insert must still store every alert exactly once. Runs in its own
process: task retries need a ``local[N,F]`` master."""

import os
import subprocess
import sys
import tempfile

from conftest import ROOT

SCRIPT = r'''
import sys
sys.path.insert(0, ROOT)
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", CKPT).getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from logwarden.operators.alerts import alert_records
from logwarden.operators.features import window_features
from logwarden.operators.scoring import score
from logwarden.plans.fixed_model import fixed_bundle
from logwarden.sinks.alert_store import insert_alerts, read_alerts
from logwarden.sources.fixtures import load_logs

@F.udf("boolean")
def lose_first_attempt(_):
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() == 0:
        raise RuntimeError("executor lost")
    return True

alerts = alert_records(score(window_features(load_logs(spark, SF), "6 hours"), fixed_bundle()))
expected = alerts.count()
flaky = alerts.filter(lose_first_attempt(F.col("id")))
insert_alerts(spark, flaky, STORE)
insert_alerts(spark, flaky, STORE)
got = read_alerts(spark, STORE)
print("RESULT", expected, got.count(), got.select("id").distinct().count())

# the same under a stream: failures inside the stateful micro-batch
from logwarden.streaming import logs_from_event_files, run_until_idle, start_detection
stream = logs_from_event_files(spark, SF + "/events*.parquet")
stream = stream.filter(lose_first_attempt(F.col("relatedObjectId")))
run_until_idle(start_detection(stream, fixed_bundle(), STORE + "-stream", CKPT + "/stream",
                               {"availableNow": True}))
got = read_alerts(spark, STORE + "-stream")
print("STREAM", expected, got.count(), got.select("id").distinct().count())
'''


def test_task_failures_do_not_duplicate_or_lose_alerts():
    """Batch insert and detection stream, each with a lost first task attempt."""
    tmp = tempfile.mkdtemp(prefix="lw-retry-", dir="/tmp")
    code = (f"ROOT = {ROOT!r}\nCKPT = {tmp + '/ckpt'!r}\nSF = '/root/testdata/sf0.01'\n"
            f"STORE = {tmp + '/store'!r}\n" + SCRIPT)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         timeout=600, env=dict(os.environ))
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    expected, stored, distinct = map(int, line[0].split()[1:])
    assert expected > 0 and stored == distinct == expected
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("STREAM")]
    assert line, out.stderr[-2000:]
    expected, stored, distinct = map(int, line[0].split()[1:])
    assert stored == distinct == expected
