"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe_codec import codec_digests
from .common import read_table, table_reader
from .decontaminate import contamination
from .nearest import self_search
from .oracle import ORACLE_SQL as ORACLE_SQL
from .packing import pack_documents
from .paragraphs import removed_paragraphs
from .quality_classifier import score
from .quality_rules import judge
from .ranked_search import search
from .sharding import shards
from .simhash import near_duplicates
from .spelling_variants import variant_groups
from .suffix_dedup import remove_repeats
from .token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def _quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _on_benchmark(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """``operator`` over all documents and all benchmark items."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return query


QUERIES: dict[str, Query] = {
    "op1_token_counts": table_reader("documents", token_counts),
    "op2_simhash_near_dedup": table_reader("documents", near_duplicates),
    "op3_substring_dedup": table_reader("documents", removed_paragraphs),
    "op4_bpe_codec": table_reader("documents", codec_digests),
    "op5_sharding": table_reader("documents", shards),
    "op6_quality_rules": table_reader("documents", judge),
    "op7_suffix_dedup": table_reader("documents", remove_repeats),
    "op8_nearest_neighbours": table_reader("embeddings", self_search),
    "op9_best_fit_packing": table_reader("documents", pack_documents),
    "op10_quality_classifier": _quality_scores,
    "op11_spelling_variants": table_reader("documents", variant_groups),
    "op12_decontamination": _on_benchmark(contamination),
    "op13_ranked_search": _on_benchmark(search),
}
