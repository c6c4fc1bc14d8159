"""Benchmark decontamination by a broadcast set of test n-grams (operator 12).

Texts become words of letters, digits and everything beyond ASCII, lower-cased.
The windows of WINDOW consecutive words of every test item (all its words if it
has fewer) are hashed once; the set of them goes to every worker, and one pass
over the documents hashes the window from each word on and sifts it against the
set. A hit is verified by a 128-bit digest of the window's own words. The words
inside verified windows are hit.

The set's size is bounded: it travels in blocks of at most about BLOCK rows
(window, item), with a fixed number of bytes each. One block is the rule; a test
set of more blocks is taken block by block, each against all documents, and the
hits of a row are merged. Nothing is collected but one block at a time.

Defined results: null and empty texts have no words and no hits, an item without
words has no windows; items with one id are one item with the windows of all its
rows, a null item id counts as the empty text; repeated rows of documents are
judged alike; texts are taken whole, and spans are judged on the input, not on
what a cut leaves. Extra columns are kept by the functions that return documents
and ignored by the others; an empty table on either side gives no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, materialize, text_hash, text_or_empty
from .lexical import Sieve, WordHash, Words, word_groups

WINDOW = 10
#: (window, item) rows of one broadcast.
BLOCK = 500_000

SPAN = "struct<first: int, stop: int, begin: int, end: int>"
_FOUND = {"n_words": "long", "spans": f"array<{SPAN}>", "items": "array<string>"}
_SPAN_TYPE = pa.struct([(n, pa.int32()) for n in ("first", "stop", "begin", "end")])


def digest(words: Words, first: int, length: int) -> bytes:
    return hashlib.blake2b(words.text[words.begin[first]:words.end[first + length - 1]].tobytes(),
                           digest_size=16).digest()


def item_windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """(length, hash, digest, item): the distinct windows of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHash()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for w in word_groups(batch.column(1)):
                hashes = hasher.words(w.text, w.begin, w.end)
                for r in np.flatnonzero(w.count).tolist():
                    length = min(size, int(w.count[r]))
                    at = range(int(w.first[r]), int(w.first[r + 1]) - length + 1)
                    h = hasher.runs(hashes[at.start:at.stop + length - 1], length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([length] * len(at), pa.int32()), pa.array(h.view(np.int64)),
                         pa.array([digest(w, i, length) for i in at], pa.binary()),
                         pa.array([ids[w.rows[0] + r]] * len(at), pa.string())],
                        names=["length", "hash", "digest", "item"])

    bound_batches(benchmark.sparkSession)
    return benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit("")).alias("item"),
                            text_or_empty(benchmark[text_col]).alias("text")).mapInArrow(
        run, "length int, hash long, digest binary, item string").distinct()


class WindowSet:
    """A block of test windows: by length a sieve of their hashes, and the items
    of each digest."""

    def __init__(self, block: pa.Table):
        self.items: dict[bytes, list[str]] = {}
        for d, item in zip(block.column("digest").to_pylist(), block.column("item").to_pylist()):
            self.items.setdefault(d, []).append(item)
        lengths = block.column("length").to_numpy()
        hashes = block.column("hash").to_numpy().view(np.uint64)
        self.sieves = {int(n): Sieve(hashes[lengths == n]) for n in np.unique(lengths)}
        self.hasher = WordHash()

    def scan(self, w: Words) -> tuple[np.ndarray, list[set[str]]]:
        """(whether each word is hit, items of each row)."""
        hashes = self.hasher.words(w.text, w.begin, w.end)
        row = w.row
        edge = np.zeros(len(row) + 1, np.int64)
        items: list[set[str]] = [set() for _ in w.count]
        for length, sieve in self.sieves.items():
            at, _ = sieve.find(self.hasher.runs(hashes, length))
            at = at[row[at] == row[at + length - 1]]           # inside one row
            for i in at.tolist():
                found = self.items.get(digest(w, i, length))
                if found:
                    items[row[i]].update(found)
                    edge[i] += 1
                    edge[i + length] -= 1
        return np.cumsum(edge[:-1]) > 0, items


def spans_of(w: Words, hit: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(spans of each row, their first and stop word and first and stop byte)."""
    row = w.row
    new_row = np.ones(len(row), bool)
    new_row[1:] = row[1:] != row[:-1]
    before = np.zeros(len(row), bool)
    before[1:] = hit[:-1]
    first = np.flatnonzero(hit & (~before | new_row))
    after = np.zeros(len(row), bool)
    after[:-1] = hit[1:] & ~new_row[1:]
    last = np.flatnonzero(hit & ~after)
    n = np.bincount(row[first], minlength=len(w.count))
    base = w.first[row[first]]
    return n, [first - base, last + 1 - base, w.start[first], w.stop[last]]


def _scan(docs: DataFrame, block: pa.Table, names: dict[str, str]) -> DataFrame:
    """``docs`` (text last) with the hits of one block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowSet(shared.value)
        for batch in batches:
            counts, n_spans, parts, items = [], [], [], []
            for w in word_groups(batch.column(batch.num_columns - 1)):
                hit, found = windows.scan(w)
                n, places = spans_of(w, hit)
                counts.append(w.count)
                n_spans.append(n)
                parts.append(places)
                items += [sorted(x) for x in found]
            joined = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(4)]
            ends = np.cumsum(np.concatenate([[0], *n_spans])).astype(np.int32)
            spans = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int32)) for x in joined], fields=list(_SPAN_TYPE)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate([[], *counts]).astype(np.int64)), spans,
                 pa.array(items, pa.list_(pa.string()))], names=[*batch.schema.names, *names.values()])

    schema = T.StructType([*docs.schema.fields, *[
        T.StructField(names[n], T._parse_datatype_string(kind)) for n, kind in _FOUND.items()]])
    return docs.mapInArrow(run, schema)


def _blocks(windows: DataFrame, size: int) -> Iterator[pa.Table]:
    n = max(1, -(-windows.count() // size))
    part = F.pmod(F.xxhash64("digest", "item"), F.lit(n))
    for i in range(n):
        yield (windows if n == 1 else windows.filter(part == i)).toArrow()


def free_names(docs: DataFrame, names: tuple[str, ...]) -> dict[str, str]:
    """Column names that ``docs`` does not have yet."""
    taken, out = {c.lower() for c in docs.columns}, {}
    for name in names:
        out[name] = name
        while out[name].lower() in taken:
            out[name] += "_"
    return out


def with_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text_col: str = "text",
              item_col: str = "item_id", block: int = BLOCK) -> tuple[DataFrame, dict[str, str]]:
    """The columns of ``docs`` with n_words, spans and items, and the names that
    these three got (others where ``docs`` has columns of those names)."""
    bound_batches(docs.sparkSession)
    windows = materialize(item_windows(benchmark, size, item_col), "windows")
    names = free_names(docs, tuple(_FOUND))
    blocks = _blocks(windows, block)
    others = [c for c in docs.columns if c != text_col]
    at_end = docs.select(*[docs[c] for c in others], docs[text_col])
    one = next(blocks)
    if windows.count() <= block:
        return _scan(at_end, one, names).select(
            *[F.col(f"`{c}`") for c in docs.columns], *names.values()), names
    # Rows are named by their text: the same text has the same hits.
    texts = materialize(docs.select(text_or_empty(docs[text_col]).alias("text")).distinct()
                        .select(text_hash("text").alias("mark"), F.md5("text").alias("md5"), "text"), "texts")
    found = None
    while one is not None:
        part = _scan(texts, one, {n: n for n in _FOUND}).drop("text").filter(F.size("items") > 0)
        part = materialize(part, "hits")
        found = part if found is None else found.unionByName(part)
        one = next(blocks, None)
    merged = found.groupBy("mark", "md5").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = merged.withColumn("spans", merged_spans(F.col("spans")))
    empty = pa.table({"length": pa.array([], pa.int32()), "hash": pa.array([], pa.int64()),
                      "digest": pa.array([], pa.binary()), "item": pa.array([], pa.string())})
    key = free_names(docs, (*_FOUND, "mark", "md5"))
    counted = _scan(at_end, empty, names).drop(names["spans"], names["items"]).withColumns(
        {key["mark"]: text_hash(text_or_empty(F.col(f"`{text_col}`"))),
         key["md5"]: F.md5(text_or_empty(F.col(f"`{text_col}`")))})
    hits = merged.select(F.col("mark").alias(key["mark"]), F.col("md5").alias(key["md5"]),
                         F.col("spans").alias(names["spans"]), F.col("items").alias(names["items"]))
    joined = counted.join(hits, [key["mark"], key["md5"]], "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], names["n_words"], *[
        F.coalesce(names[n], F.array().cast(_FOUND[n])).alias(names[n]) for n in ("spans", "items")]), names


def merged_spans(spans):
    """Sorted spans that overlap or touch, as one."""
    def add(done, s):
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["stop"], s["stop"]).alias("stop"),
                          last["begin"].alias("begin"), F.greatest(last["end"], s["end"]).alias("end"))
        meets = (F.size(done) > 0) & (s["first"] <= F.try_element_at(done, F.lit(-1))["stop"])
        return F.when(meets, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                                      F.array(longer))).otherwise(F.concat(done, F.array(s)))
    return F.aggregate(spans, F.array().cast(f"array<{SPAN}>"), add)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row a document: its words, those hit, and the items found in it."""
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    found, _ = with_hits(slim, benchmark, size, block=block)
    return found.select(
        "doc_id", "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                    text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` without the documents that hold a test window."""
    found, names = with_hits(docs, benchmark, size, text_col, block=block)
    return found.filter(F.size(names["spans"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` with the hit words, and what stands between them, cut out of the
    texts; what stood before and after a cut is left as it was."""
    found, names = with_hits(docs, benchmark, size, text_col, block=block)
    raw = F.col(f"`{text_col}`").cast("binary")
    spans = F.col(names["spans"])
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["begin"]), F.array(F.octet_length(raw)))
    kept = F.zip_with(begins, ends, lambda b, e: F.substring(raw, b + 1, e - b).cast("string"))
    text = F.when(F.size(spans) == 0, F.col(f"`{text_col}`")).otherwise(F.array_join(kept, ""))
    return found.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
