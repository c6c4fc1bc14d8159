"""The corpus pipeline on the smallest table and on planted rows."""

import os

import pytest
from helpers import SF001

import __spark_entry__
import corpus_pipeline
from logwarden.llm import packing, paragraphs, quality_rules
from logwarden.llm.common import materialize


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The smallest documents with exact and near copies and junk added."""
    d = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    long = [r for r in rows.values() if 200 < len(r.text.split()) < 3000][:6]
    more = [(70000 + i, r.text, r.lang, r.source, r.n_chars) for i, r in enumerate(long)]
    more += [(71000 + i, r.text.replace(r.text.split()[50], "changed", 1), r.lang, r.source, r.n_chars)
             for i, r in enumerate(long)]
    more += [(72000, "junk### " * 200, "en", "s", 1600), (72001, None, "en", "s", 0)]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{SF001}/labels.parquet").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "simhash_near_dedup", "substring_dedup",
        "best_fit_packing"]
    judged = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, planted), f"test-{name}")
        assert docs.columns == columns
        rows = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(rows) <= before
        before = len(rows)
        if name == "quality_rules":
            assert set(rows) == {i for i, k in judged.items() if k}
        if name == "simhash_near_dedup":
            assert not [i for i in rows if 70000 <= i < 71000]      # exact copies are gone
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, planted).collect()
    assert {r.doc_id for r in packed} == set(rows)


def test_run_equals_the_stages(spark, planted):
    got = corpus_pipeline.run(spark, planted)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, planted), "again")
    want = packing.pieces(docs).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(tuple, want))


def _tables(spark, path, rows):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF001}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, _tables(spark, str(tmp_path), [])).collect() == []


def test_null_ids_repeated_rows_and_a_shared_passage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    judged = quality_rules.keep_documents(docs)
    good = [tuple(r) for r in judged.filter("length(text) > 1500").orderBy("doc_id").limit(12).collect()]
    assert len(good) == 12
    passage = " ".join(good[0][1].split()[:120])
    rows = good + good[3:6]                                          # repeated rows
    rows += [(None, *r[1:]) for r in good[6:8]]                      # copies without an id
    rows += [(80000 + i, f"{r[1]}\n{passage}", *r[2:]) for i, r in enumerate(good[8:11])]
    path = _tables(spark, str(tmp_path), rows)
    before = spark.read.parquet(f"{path}/documents.parquet")
    cut = {r.doc_id: r.text for r in paragraphs.cut_documents(before).collect()}
    assert not any(passage in (cut.get(80000 + i) or "") for i in range(3))     # the later copies go
    out = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in out} <= {r[0] for r in rows}
    places = [(r.sequence_id, r.offset) for r in out]
    assert len(places) == len(set(places))
    kept = [r.doc_id for r in out if r.piece == 0 and r.doc_id is not None]
    assert len(kept) == len(set(kept))                               # one row of repeated ones


def test_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert os.path.exists(corpus_pipeline.__file__)
