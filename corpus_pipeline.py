"""Corpus pipeline: quality rules, quality classifier, near-duplicates,
repeated passages, packing.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame; its rows are written as Parquet to the shared
checkpoint folder and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logwarden.llm import packing, paragraphs, quality_classifier, quality_rules, simhash
from logwarden.llm.common import materialize, read_table


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality probability is at least a half."""
    return quality_rules.keep_documents(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that labelled neighbours vote good. The model is fitted on the
    labelled documents of the corpus, not only on those kept so far."""
    model = quality_classifier.fit(read_table(spark, sf_dir, "documents"),
                                   read_table(spark, sf_dir, "labels"))
    return quality_classifier.keep_documents(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document holds."""
    return paragraphs.cut_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, placed in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL cannot express the learned and iterative stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
