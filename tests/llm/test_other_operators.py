"""Sharding, quality rules, classifier and nearest neighbours."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import EDGE, SF001, documents, frame, words

from logwarden.llm import nearest, quality_classifier, quality_rules, sharding


# -- sharding -------------------------------------------------------------------

def least_largest(sizes, k):
    lo, hi = max(sizes, default=0), sum(sizes)
    while lo < hi:
        m, n, c = (lo + hi) // 2, 1, 0
        for x in sizes:
            if c + x > m:
                n, c = n + 1, 0
            c += x
        lo, hi = (lo, m) if n <= k else (m + 1, hi)
    return lo


@pytest.mark.parametrize("knots,shards", [(1 << 16, 40), (16, 40), (16, 7), (4, 1)])
@pytest.mark.parametrize("hot", [False, True])
def test_shards_are_minimax(spark, knots, shards, hot):
    rows = documents(spark) + EDGE
    if hot:                                     # copies with a third of all bytes
        rows = rows + [(50000 + i, "copy " * 200) for i in range(250)]
    got = sharding.shards(frame(spark, rows), shards, knots=knots).collect()
    text = defaultdict(list)
    for i, t in rows:
        text[i].append(t or "")
    by, slots, shard_of = Counter(), defaultdict(list), {}
    assert len(got) == len(rows)
    for r in got:
        assert any(r.size == len(t.encode()) + 16 and r.text_crc32 == zlib.crc32(t.encode())
                   for t in text[r.doc_id])
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert shard_of.setdefault((r.text_crc32, r.size), r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 16
    placed = [(xxhash.xxh64_intdigest(t.encode(), 42), n) for t, n in groups.items()]
    total, left, large = sum(groups.values()), shards, set()
    for p, n in sorted(placed, key=lambda x: -x[1]):
        if left < 2 or n * left <= total:
            break
        large.add(p)
        total, left = total - n, left - 1
    want = least_largest([n for p, n in sorted(placed) if p not in large], left)
    assert max(n for s, n in by.items() if s >= len(large)) == want
    assert bool(large) == (hot and shards > 1) or shards > 7


def test_even_cuts_respect_the_capacity():
    sums = [0, 5, 6, 7, 12, 14, 20]
    capacity = sharding.least_capacity(sums, 3)
    ends = [0, *sharding.even_cuts(sums, capacity, 3), 20]
    assert all(b - a <= capacity for a, b in zip(ends, ends[1:])) and len(ends) == 4


# -- quality rules ----------------------------------------------------------------

def base_figures(text):
    w = words(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").encode().split(b"\n"):
        if re.search(rb"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))


def test_base_figures_and_verdicts(spark):
    rows = documents(spark) + EDGE
    docs = frame(spark, rows)
    got = quality_rules.judge(docs).collect()
    want = sorted(((i, *base_figures(t)) for i, t in rows), key=str)
    assert sorted((tuple(r)[:6] for r in got), key=str) == want
    for r in got:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    kept = quality_rules.keep_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    judged = [(r.kept, labels[r.doc_id]) for r in got if r.doc_id in labels and not r.base_failed]
    assert sum(k == (q == 1) for k, q in judged) >= 0.95 * len(judged)


def test_em_learns_which_rules_are_right():
    """Two rules that follow the truth and one that votes at random."""
    rng = np.random.default_rng(0)
    good = rng.random(4000) < 0.8
    votes = np.stack([np.where(rng.random(4000) < p, np.where(good, 1, -1), np.where(good, -1, 1))
                      for p in (0.97, 0.95, 0.9)] + [np.where(rng.random(4000) < 0.5, 1, -1)], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, reject = quality_rules.estimate(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.05
    assert (reject[0, :3] < 0.15).all() and (reject[1, :3] > 0.8).all()
    assert abs(reject[0, 3] - reject[1, 3]) < 0.1


# -- classifier -------------------------------------------------------------------

def test_held_out_quality(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.score(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == 1000
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.95


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.createDataFrame(documents(spark), "doc_id long, text string")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 "
                                "THEN 1 - quality ELSE quality END AS quality")
    a, b = (sorted(map(tuple, quality_classifier.score(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_votes_by_plain_computation(spark):
    """Scores against cosines and votes worked out one text at a time."""
    docs = spark.createDataFrame(documents(spark), "doc_id long, text string")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    used = {r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    assert len(model.labels) == len(used & {r.doc_id for r in docs.collect()})
    got = {r.doc_id: r.score for r in quality_classifier.score(docs, labels, model=model).collect()}
    counter, voters = quality_classifier.TermCounter(), model.vectors.astype(float)
    for doc_id, text in documents(spark):
        counts = next(iter(counter.blocks(pa.array([text or ""]))))[0]
        x = quality_classifier.weighted(counts[None], model.idf)[0] @ model.directions
        if not np.linalg.norm(x):
            continue
        cosines = sorted(((float(v @ x) / np.linalg.norm(x), label)
                          for v, label in zip(voters, model.labels)), reverse=True)
        near = cosines[:quality_classifier.NEIGHBOURS]
        weights = [max(c, 0) ** quality_classifier.SHARPNESS for c, _ in near]
        want = sum(w * label for w, (_, label) in zip(weights, near)) / sum(weights)
        edge = cosines[len(near) - 1][0] - cosines[len(near)][0] if len(cosines) > len(near) else 1
        assert abs(got[doc_id] - want) < (1e-4 if edge > 1e-6 else 0.1)


def test_classifier_edges(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    docs = frame(spark, EDGE)
    got = quality_classifier.score(docs, labels.limit(0)).collect()
    assert [r.score for r in got] == [0.5] * len(EDGE)
    model = quality_classifier.fit(frame(spark, documents(spark)), labels.union(labels).unionByName(
        spark.createDataFrame([(None, 1, 0), (3, None, 0)], labels.schema)))
    blank = [r for r in quality_classifier.score(docs, labels, model=model).collect()
             if r.doc_id in (900001, 900002, 900003)]
    assert {round(r.score, 9) for r in blank} == {round(float(model.labels.mean()), 9)}
    kept = quality_classifier.keep_documents(docs, model)
    assert kept.columns == docs.columns and kept.count() <= len(EDGE)
    assert quality_classifier.score(docs.limit(0), labels, model=model).collect() == []


# -- nearest neighbours -----------------------------------------------------------

def even(v):
    """Scaled to a largest component of one."""
    return v / np.abs(v).max()


def exact(rows, k, step):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v)
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % step == 0:
            scored = sorted((-float(even(v) @ even(c) / np.linalg.norm(even(v)) / np.linalg.norm(even(c))), j)
                            for j, c in ok if j != i and len(c) == len(v))
            out[i] = scored[:k]
    return out


@pytest.mark.parametrize("tile", [(2048, 8192), (3, 40)])
def test_neighbours_by_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(nearest, "TILE_QUERIES", tile[0])
    monkeypatch.setattr(nearest, "TILE_CANDIDATES", tile[1])
    rng = random.Random(0)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(12)]                       # equal scores
    rows += [(400, None), (401, [0.0] * 8), (450, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8),
             (403, [float("inf")] * 8), (404, []), (None, [1.0] * 8), (405, [1e200] * 8),
             (407, [1e-200] * 8), (500, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows],
                                  "vec_id long, embedding array<double>, score string").repartition(4)
    got = defaultdict(list)
    for r in sorted(nearest.self_search(table, 10, 5).collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(got[r.query_id]) + 1
        got[r.query_id].append((r.score, r.vec_id))
    want = exact(rows, 5, 10)
    assert set(got) == {q for q, v in want.items() if v}
    for q, v in got.items():
        assert [j for _, j in v] == [j for _, j in want[q]]
        assert np.allclose([s for s, _ in v], [-s for s, _ in want[q]], atol=1e-12)


def test_scores_of_extreme_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1e-200, 0.0]), (2, [1e200, 1e200]), (3, [0.0, 1e308]), (50, [5e-324, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in nearest.self_search(table).collect()}
    assert len(got) == 8 and got[0, 1] == got[0, 50] == got[50, 1] == 1.0 and got[0, 3] == 0.0
    assert abs(got[0, 2] - 0.5 ** 0.5) < 1e-15 and abs(got[50, 2] - 0.5 ** 0.5) < 1e-15


def test_quantised_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 16))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    codes, scale, error = nearest.quantise(unit)
    near = (codes.astype(float) @ codes.astype(float).T) * scale[:, None] * scale
    slack = error[:, None] + error * (1 + error[:, None])
    assert (np.abs(near - unit @ unit.T) <= slack + 1e-12).all()


def test_empty_tables(spark):
    docs = frame(spark, [(1, "x")]).limit(0)
    assert sharding.shards(docs).collect() == []
    assert quality_rules.judge(docs).collect() == []
    assert quality_rules.keep_documents(docs).collect() == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest.self_search(empty).collect() == []
