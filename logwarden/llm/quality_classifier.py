"""Quality by nearest-neighbour voting over latent-semantic vectors (operator 10).

Words count as terms twice: by content (hashed) and by shape (kinds of their
first and last character, capitals, length, sameness with the word before).
Document frequencies come from all texts. A bounded sample of labelled texts
(SAMPLE, the smallest by a hash of the id) gives the latent directions of the
weighted term table, its own vectors, and the labels that vote. The sample's
vectors are broadcast; for every text the exact cosines to all of them are
computed in blocks, and the NEIGHBOURS nearest vote with their similarity as
weight. Labels, language, source and id are never inputs of a score.

Defined results: a text without words (null or empty) has no vector and gets
the sample's share of label 1; without any labelled text every score is 0.5;
labels that contradict each other for one id are left out; repeated rows and
null ids each get their own row; extra columns are ignored by ``score`` and
kept by ``keep_documents``; an empty table gives no rows; texts of any length
count whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, text_or_empty
from .word_ids import Hasher, column_bytes, row_groups, word_bounds

#: Labelled texts that vote, at most.
SAMPLE = 4000
DIRECTIONS = 64
NEIGHBOURS = 25
#: Power of the similarity that weighs a vote.
SHARPNESS = 4
THRESHOLD = 0.3
#: Every FOLDS-th id (by checksum) is held out.
FOLDS = 5
#: Texts in one block of cosines.
BLOCK = 256

CONTENT_TERMS = 424
_FIRST, _LAST, _SIZES = 5, 6, 5
SHAPE_TERMS = _FIRST * _LAST * _SIZES * 2 * 2
TERMS = CONTENT_TERMS + SHAPE_TERMS


def _kinds(groups: list[str], rest: int) -> np.ndarray:
    table = np.full(256, rest, np.int64)
    for k, chars in enumerate(groups):
        table[[ord(c) for c in chars]] = k
    return table


_LOW, _UP, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_FIRST_KIND = _kinds([_LOW, _UP, _DIGIT], 3)
_FIRST_KIND[128:] = 4
_LAST_KIND = _kinds([_LOW + _UP, _DIGIT, "!", ".,;:?", "#*$%&|<>"], 5)
_SIZE_KIND = np.digitize(np.arange(64), [2, 4, 8, 13])
_IS_UP = np.zeros(256, bool)
_IS_UP[[ord(c) for c in _UP]] = True
_IS_LOW = np.zeros(256, bool)
_IS_LOW[[ord(c) for c in _LOW]] = True
_TO_LOW = np.arange(256, dtype=np.uint8)
_TO_LOW[_IS_UP] += 32


class TermCounter:
    """Term counts of texts as rows of a dense array."""

    def __init__(self):
        self.hasher = Hasher()

    def blocks(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Counts (rows x TERMS) of stretches of rows, in order."""
        data, offsets = column_bytes(column)
        for a, b in row_groups(offsets):
            for x in range(a, b, BLOCK):
                y = min(x + BLOCK, b)
                yield self.group(data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x])

    def group(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts, ends = word_bounds(data, offsets)
        first = np.searchsorted(starts, offsets)
        n = len(offsets) - 1
        row = np.repeat(np.arange(n), np.diff(first))
        words = self.hasher.ranges(self.hasher.sums(_TO_LOW[data]), starts, ends)

        def within(flag: np.ndarray) -> np.ndarray:
            total = np.zeros(len(data) + 1, np.int64)
            np.cumsum(flag[data], out=total[1:])
            return total[ends] - total[starts]

        echo = np.zeros(len(starts), np.int64)
        echo[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
        shout = ((within(_IS_UP) > 1) & (within(_IS_LOW) == 0)).astype(np.int64)
        size = _SIZE_KIND[np.minimum(ends - starts, 63)]
        shape = _FIRST_KIND[data[starts]] if len(starts) else np.zeros(0, np.int64)
        for kind, number in ((_LAST_KIND[data[ends - 1]] if len(ends) else shape, _LAST),
                             (size, _SIZES), (shout, 2), (echo, 2)):
            shape = shape * number + kind
        content = (words % np.uint64(CONTENT_TERMS)).astype(np.int64) + SHAPE_TERMS
        counts = np.bincount(row * TERMS + shape, minlength=n * TERMS)
        counts += np.bincount(row * TERMS + content, minlength=n * TERMS)
        return counts.reshape(n, TERMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length one (or zero): damped term shares times rarity."""
    x = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, np.ndarray]:
    """Texts, and how many of them hold each term (over all texts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, n, seen = TermCounter(), 0, np.zeros(TERMS, np.int64)
        for batch in batches:
            for block in counter.blocks(batch.column(0)):
                n += len(block)
                seen += (block > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS + 1), pa.int32()), pa.array(np.r_[seen, n], pa.int64())],
            names=["term", "n"])

    rows = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(
        run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(TERMS + 1, np.int64)
    for r in rows:
        found[r["term"]] = r["n"]
    return int(found[-1]), found[:-1]


@dataclass
class Model:
    idf: np.ndarray
    directions: np.ndarray      # terms x latent
    vectors: np.ndarray         # labelled texts x latent, length one
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        x = weighted(counts, self.idf) @ self.directions
        return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        share = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels) or not len(counts):
            return np.full(len(counts), share)
        near = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        vote = (weight * self.labels[best]).sum(axis=1)
        return np.clip(np.where(total > 0, vote / np.maximum(total, 1e-300), share), 0, 1)


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Model from all texts' term frequencies and at most ``sample`` labels."""
    bound_batches(docs.sparkSession)
    n, seen = document_frequencies(docs, text_col)
    idf = np.log((1 + n) / (1 + seen)) + 1
    chosen = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)) \
        .groupBy(id_col).agg(F.min(label_col).alias("low"), F.max(label_col).alias("label")) \
        .filter("low = label").orderBy(F.xxhash64(id_col), id_col).limit(sample)
    texts = docs.select(id_col, text_or_empty(text_col).alias("text")).join(
        F.broadcast(chosen.select(id_col, "label")), id_col).dropDuplicates([id_col])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter()
        for batch in batches:
            blocks = list(counter.blocks(batch.column(2)))
            rows = [r.astype(np.int32).tobytes() for b in blocks for r in b]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.binary())],
                names=["id", "label", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.select(id_col, F.col("label").cast("int"), "text").mapInArrow(
        count, f"id {kind}, label int, counts binary").collect()
    rows = sorted((r for r in rows if any(r["counts"])), key=lambda r: r["id"])
    if not rows:
        return Model(idf, np.zeros((TERMS, 1)), np.zeros((0, 1), np.float32), np.zeros(0))
    blocks = [np.stack([np.frombuffer(r["counts"], np.int32) for r in rows[i:i + BLOCK]])
              for i in range(0, len(rows), BLOCK)]
    square = sum(x.T @ x for x in (weighted(b, idf) for b in blocks))
    value, vector = np.linalg.eigh(square)      # right singular vectors, largest last
    keep = min(DIRECTIONS, int((value > 1e-9).sum()))
    model = Model(idf, vector[:, ::-1][:, :keep].copy(), np.zeros((0, keep), np.float32),
                  np.array([r["label"] for r in rows], float))
    model.vectors = np.concatenate([model.latent(b) for b in blocks])
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", model: Model | None = None) -> DataFrame:
    """(id, held_out, score, predicted) of every text."""
    model = model or fit(docs, labels, id_col, text_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter()
        for batch in batches:
            found = [shared.value.scores(b) for b in counter.blocks(batch.column(1))]
            s = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())],
                                             names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_or_empty(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, score double").select(
            id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least THRESHOLD."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            found = [shared.value.scores(b) for b in counter.blocks(column)]
            if found:
                yield batch.filter(pa.array(np.concatenate(found) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
