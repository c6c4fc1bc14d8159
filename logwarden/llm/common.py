"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.session import delete_path, scratch_path

#: Bytes of one Arrow batch handed to a Python worker: bounds a worker's
#: memory however long the texts of a batch are (one row always fits whole).
BATCH_BYTES = "8m"


def bound_batches(spark: SparkSession) -> None:
    """Python workers get at most BATCH_BYTES at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_reader(name: str, operator: Callable[[DataFrame], DataFrame]):
    """A registered query: ``operator`` over the whole table ``name``."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(read_table(spark, sf_dir, name))
    return query


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def text_hash(col: str | Column) -> Column:
    """64-bit hash of a text: with the id it names a row of a table whose ids
    are null or shared (equal rows have equal names and equal results)."""
    return F.xxhash64(col)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh folder of the shared checkpoint directory
    and read it back: later steps reuse the rows and a lost executor costs a
    re-read, not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_folder = path
    return table


def release(spark: SparkSession) -> None:
    """Have the driver's JVM let go of the finished steps: Spark deletes their
    shuffle files when their plans are collected, which a quiet driver puts off
    for up to half an hour."""
    spark.sparkContext._jvm.System.gc()


def drop_scratch(*tables: DataFrame) -> None:
    """Delete the folders of ``materialize``d tables that nothing reads any more
    (no frame made from them may still be run), and ``release`` what made them."""
    for table in tables:
        delete_path(table.sparkSession, table._scratch_folder)
    release(tables[0].sparkSession)


def shared_keys(rows: DataFrame, *keys: str, count: str = "n", hint: str = "") -> DataFrame:
    """Rows whose keys occur more than once, with the number of rows that have
    them. The counts are pre-aggregated in the map tasks, written, and joined
    back: a join of two plain tables, in which Spark can split a key with very
    many rows over tasks (a window would hold it in one). ``hint``: how."""
    counts = materialize(rows.groupBy(*keys).agg(F.count("*").alias(count)).filter(
        F.col(count) > 1), "key-counts")
    release(rows.sparkSession)                     # of the counts, before the join
    return rows.join(counts.hint(hint) if hint else counts, list(keys))
