"""Driver contract: entry smoke run, query/oracle key agreement, and every
query against its DuckDB SQL on the smallest test data."""

import os
import re
import sys

import duckdb
import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as E  # noqa: E402
import check_oracle  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

check_oracle.EXACT = True          # floats compared bit-for-bit

NO_SQL = {"kmeans_profile"}        # iterative fit: rows-only check


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    from logwarden.schemas import ALERT_COLUMNS
    assert df.columns == ALERT_COLUMNS
    n = df.count()
    assert n >= 0
    assert E.entry(spark).schema == df.schema


def test_every_query_has_sql_unless_exempt():
    own = {n for n in E.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own - set(E.oracle_sql()) == NO_SQL
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert len(a) == len(b)
    assert a == b


def test_kmeans_profile_rows(spark):
    df = E.queries()["kmeans_profile"](spark, SF001)
    rows = df.collect()
    assert len(rows) == 3
    assert sum(r["size"] for r in rows) == 340          # 6-hour groups at sf0.001
