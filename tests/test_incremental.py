"""Scaler moments and k-means cells kept by date against fits on all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logwarden.operators import incremental
from logwarden.operators.incremental import (date_cells, date_moments, merged_cells, merged_scaler, refit,
                                             refit_scaler, refresh_partials, stored_dates)
from logwarden.operators.model import fit_partitions, train, train_scaler
from logwarden.operators.scoring import squared_distance, z_columns

W = "15 minutes"


def feature_rows(days, seed=0):
    rng, rows = random.Random(seed), []
    for d in days:
        for i in range(60):
            at = dt.datetime(2024, 1, d) + dt.timedelta(minutes=15 * (i // 3))
            hot = rng.random() < 0.1
            n = rng.randint(500, 600) if hot else rng.randint(20, 200)
            e = int(n * (rng.uniform(0.3, 0.5) if hot else rng.uniform(0, 0.1)))
            rows.append((at, at + dt.timedelta(minutes=15), f"s{i % 3}", n, e,
                         None if i == 0 else rng.uniform(20, 60), round(100 * e / n, 2)))
    return rows


@pytest.fixture(scope="module")
def feats(spark):
    from logwarden.schemas import FEATURE_SCHEMA
    return spark.createDataFrame(feature_rows(range(1, 11)), FEATURE_SCHEMA).persist()


def cost(feats, bundle):
    z = z_columns(bundle)
    return feats.agg(F.sum(F.array_min(F.array(*[squared_distance(z, c) for c in bundle.centers])))).first()[0]


def test_moments_merge_to_the_full_fit(spark, feats):
    full, got = train_scaler(feats, W), merged_scaler(date_moments(feats), W)
    assert got.means == pytest.approx(full.means, rel=1e-12) and got.stds == pytest.approx(full.stds, rel=1e-12)


def test_refresh_reads_new_dates_only(spark, feats, tmp_dir):
    path = f"{tmp_dir}/p"
    first = feats.filter("window_start < '2024-01-06 08:00:00'")        # the sixth is unfinished
    assert refresh_partials(spark, first, path) == []
    assert stored_dates(spark, path) == [f"2024-01-0{d}" for d in range(1, 7)]
    # rows of settled dates are not read again: had they been, these would change them
    poisoned = feats.unionByName(feats.filter("window_start < '2024-01-06'"))
    for _ in range(2):
        refresh_partials(spark, poisoned, path)
        full, got = train_scaler(feats, W), refit_scaler(spark, path, W)
        assert got.means == pytest.approx(full.means, rel=1e-12) and got.stds == pytest.approx(full.stds, rel=1e-12)
    cells = spark.read.parquet(f"{path}/cells")
    assert cells.agg(F.sum("n")).first()[0] == feats.count()
    one, two = refit(spark, path, W), train(feats, W)
    assert cost(feats, one) <= cost(feats, two) * 1.01


def test_cells_merge_to_a_bound_and_lose_no_sums(spark, feats):
    grid = incremental.Grid.of(merged_scaler(date_moments(feats), W))
    cells = date_cells(feats, grid)
    fine, coarse = merged_cells(cells), merged_cells(cells, 20)
    assert coarse.count() <= 20 < fine.count()
    for c in ("n", "sum_total_logs", "sq_error_rate"):
        a, b = (x.agg(F.sum(c)).first()[0] for x in (fine, coarse))
        assert a == pytest.approx(b, rel=1e-12)


def test_the_same_dates_give_the_same_model(spark, feats, tmp_dir):
    refresh_partials(spark, feats, f"{tmp_dir}/p")
    before, centers = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in ("2", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            centers.append((refit(spark, f"{tmp_dir}/p", W).centers, train(feats, W).centers))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert centers[0] == centers[1]


def test_nothing_to_fit(spark, feats, tmp_dir):
    assert refresh_partials(spark, feats.limit(0), f"{tmp_dir}/p") == [] == stored_dates(spark, f"{tmp_dir}/p")
    with pytest.raises(ValueError, match="no feature rows"):
        merged_scaler(date_moments(feats.limit(0)), W)


def test_layout_follows_the_rows():
    assert [fit_partitions(n) for n in (0, 1, 100_000, 100_001, 10 ** 9)] == [1, 1, 1, 2, 10_000]
