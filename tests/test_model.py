"""Scaler, k-means, scoring paths, model storage, train-or-reuse."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF01, make_logs
from logwarden.operators.features import window_features
from logwarden.operators.model import (bundle_from_tables, centroid_table, ensure_model,
                                       load_bundle, model_exists, save_bundle, scaler_table,
                                       train, train_scaler)
from logwarden.operators.scoring import predict, scale, scaled_vector_columns, score
from logwarden.schemas import VECTOR_COLUMNS
from logwarden.sources.fixtures import load_logs

W = "6 hours"


def _flat(m):
    return [x for row in m for x in row]


@pytest.fixture(scope="module")
def feats(spark):
    return window_features(load_logs(spark, SF01), W).persist()


@pytest.fixture(scope="module")
def bundle(feats):
    return train(feats, W)


def test_scaler_is_mean_and_sample_std(feats, bundle):
    agg = feats.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(VECTOR_COLUMNS)],
                    *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(VECTOR_COLUMNS)]
                    ).first()
    for i in range(4):
        assert bundle.means[i] == pytest.approx(agg[f"m{i}"], rel=1e-12)
        assert bundle.stds[i] == pytest.approx(agg[f"s{i}"], rel=1e-9)


def test_zero_std_scales_to_zero(spark):
    logs = make_logs(spark, [("2024-01-01T00:00:00", "ERROR", "abc", "a", "s"),
                             ("2024-01-01T06:00:00", "ERROR", "abc", "b", "s"),
                             ("2024-01-01T12:00:00", "INFO", "abc", "c", "s")])
    f = window_features(logs, W)                # avg length is constant -> std 0
    b = train_scaler(f, W)
    assert b.stds[3] == 0.0
    zs = scaled_vector_columns(f, b).select("z_avg_message_length").collect()
    assert all(r[0] == 0.0 for r in zs)
    # the expression path applies the same rule
    ours = scale(f, b).select("z_avg_message_length").collect()
    assert all(r[0] == 0.0 for r in ours)


def test_kmeans_invariants(feats, bundle):
    scored = score(feats, bundle, keep_z=True).persist()
    n = feats.count()
    sizes = {r["prediction"]: r["n"] for r in
             scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(sizes) == 3 and sum(sizes.values()) == n
    rows = scored.collect()
    cost = 0.0
    for r in rows:
        z = [r["_z_" + c] for c in VECTOR_COLUMNS]
        d = [sum((a - b) ** 2 for a, b in zip(z, c)) for c in bundle.centers]
        assert r["prediction"] == min(range(3), key=lambda i: (d[i], i))
        cost += min(d)
    # cost of one cluster at the mean (z-space origin) is the total variance
    one = sum(sum(r["_z_" + c] ** 2 for c in VECTOR_COLUMNS) for r in rows)
    assert cost <= one


def test_expression_scoring_equals_pyspark_ml(feats, bundle):
    a = score(feats, bundle).select("window_start", "serviceName", "prediction")
    b = predict(feats, bundle).select("window_start", "serviceName",
                                      F.col("prediction").alias("p2"))
    j = a.join(b, ["window_start", "serviceName"])
    assert j.count() == feats.count()
    assert j.filter("prediction != p2").count() == 0


def test_scoring_plan_has_no_join_or_python(feats, bundle):
    plan = score(feats, bundle)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "BatchEvalPython" not in plan and "ArrowEval" not in plan


def test_clusters_ordered_by_error_rate(bundle):
    rates = [c[2] for c in bundle.unscaled_centers()]
    assert rates == sorted(rates)


@pytest.mark.parametrize("parts", [16, 4])
def test_fit_is_independent_of_input_layout(feats, parts):
    a = train(feats.repartition(1), W, partitions=parts)
    b = train(feats.repartition(7, "error_rate"), W, partitions=parts)
    c = train(feats.repartition(3).sortWithinPartitions("total_logs"), W, partitions=parts)
    for ca, cb, cc in zip(a.centers, b.centers, c.centers):
        assert ca == pytest.approx(cb, rel=1e-9, abs=1e-12)
        assert ca == pytest.approx(cc, rel=1e-9, abs=1e-12)


def test_literal_order_keeps_kmeans_ids(feats):
    b = train(feats, W, order="fit")
    assert b.fit_ids == [0, 1, 2]
    km = [list(c) for c in b.kmeans_model.clusterCenters()]
    for c1, c2 in zip(b.centers, km):
        assert c1 == pytest.approx(c2)


def test_save_load_roundtrip_and_window_check(spark, feats, bundle, tmp_dir):
    path = f"{tmp_dir}/model"
    save_bundle(spark, bundle, path)
    assert model_exists(spark, path)
    back = load_bundle(spark, path, W)
    assert _flat(back.centers) == pytest.approx(_flat(bundle.centers))
    assert back.means == pytest.approx(bundle.means)
    assert back.fit_ids == bundle.fit_ids
    p1 = score(feats, back).select("prediction").collect()
    p2 = predict(feats, back).select("prediction").collect()
    assert sorted(p1) == sorted(p2)
    with pytest.raises(ValueError):
        load_bundle(spark, path, "15 minutes")
    # overwrite works
    save_bundle(spark, bundle, path)


def test_model_tables_roundtrip(spark, bundle):
    b = bundle_from_tables(scaler_table(spark, bundle), centroid_table(spark, bundle), W)
    assert _flat(b.centers) == pytest.approx(_flat(bundle.centers))
    assert b.stds == pytest.approx(bundle.stds)


def test_model_table_size_is_checked(spark, bundle):
    big = spark.range(2000).select(F.col("id").cast("int").alias("cluster"),
                                   F.array(*[F.lit(0.0)] * 4).alias("center"))
    with pytest.raises(ValueError):
        bundle_from_tables(scaler_table(spark, bundle), big, W)


def test_ensure_model_trains_once(spark, tmp_dir):
    path = f"{tmp_dir}/model"
    calls = []

    def logs():
        calls.append(1)
        return load_logs(spark, SF01)

    b1 = ensure_model(spark, path, logs, W)
    b2 = ensure_model(spark, path, logs, W)
    assert len(calls) == 1
    assert _flat(b2.centers) == pytest.approx(_flat(b1.centers))


def test_null_average_does_not_fail(spark):
    logs = make_logs(spark, [("2024-01-01T00:00:00", "ERROR", None, "a", "s"),
                             ("2024-01-01T06:00:00", "INFO", "abc", "b", "s"),
                             ("2024-01-01T12:00:00", "INFO", "abcdef", "c", "s"),
                             ("2024-01-01T18:00:00", "ERROR", "ab", "d", "s")])
    f = window_features(logs, W)
    b = train(f, W, k=2)
    assert score(f, b).count() == 4 and predict(f, b).count() == 4
    assert not any(math.isnan(x) for x in b.means)


def test_half_written_model_is_not_used(spark, feats, bundle, tmp_dir):
    path = f"{tmp_dir}/model"
    # parts of a save that died before its pointer was written
    bundle.kmeans_model.write().overwrite().save(f"{path}/v-000000001-dead/kmeans")
    assert not model_exists(spark, path)
    save_bundle(spark, bundle, path)
    other = train(feats, W, k=2)
    save_bundle(spark, other, path)
    assert load_bundle(spark, path, W).k == 2


def test_training_without_data_is_a_clear_error(spark):
    logs = make_logs(spark, [(None, "ERROR", "m", "a", "s")])      # no time stamp
    with pytest.raises(ValueError, match="no feature rows"):
        train(window_features(logs, W), W)
