"""Ranked lexical search by the Best Position Algorithm (operator 13).

Queries are the texts of a table of items; every document is scored by

    sum over the query's terms, repeats included, of  w * ((10**9 * tf) div (1000 * tf + 8 * m))

with w = floor(1000 * ln((2 N + 2) / (2 df + 1))) and m = 25 + (75 * n * N) div L.

One pass over the documents finds the occurrences of the queries' terms (hashed,
then compared byte by byte) and keeps a row of (term, tf) a document. Corpus
figures (N, L, df) are sums over all documents. Then each task builds impact
lists over a batch of documents -- for each term its documents by falling impact
-- and runs every query over them: all lists are accessed directly at their first
unseen positions, a document met is scored at once from its own row, and its
positions in all lists count as seen. A list's best position is the end of its
contiguous seen positions; no unseen document scores more than the impacts right
behind the best positions add up to. A query stops when that bound falls
strictly below its k-th score, so equal scores keep their order by id. The k-th
score is carried from batch to batch of a task; tasks give at most k rows a
query, which a ranked window merges. The search is exact.

Queries travel in blocks of about TERMS (item, term) rows; each block is one
round over all documents. The driver holds one block's terms and their document
counts at a time.

Defined results: null and empty texts have no terms; items without terms, and
terms that no document holds, give nothing; items are the distinct rows of
(id, text), so items of one id but other texts are ranked apart and repeated
rows once; repeated documents are documents of their own; null document ids
come last among equal scores; texts are taken whole; extra columns are ignored;
an empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, materialize, text_or_empty
from .lexical import Sieve, WordHash, word_groups
from .word_ids import slices

NEAREST = 10
#: (item, term) rows of one round.
TERMS = 200_000
#: Positions of each list that the first and the largest step take.
FIRST_STEP, LAST_STEP = 16, 4096


# -- terms and postings ---------------------------------------------------------

class TermTable:
    """Known terms by their 64-bit hash; a found word is compared with its term
    byte by byte. The seed is chosen so that no two terms share a hash."""

    def __init__(self, terms: list[bytes]):
        self.count = len(terms)
        text = np.frombuffer(b" ".join(terms) + b" ", np.uint8)
        self.length = np.array([len(t) for t in terms], np.int64)
        self.begin = np.cumsum(self.length + 1) - self.length - 1
        self.text = text
        for seed in range(100):
            self.hasher = WordHash(seed)
            hashes = self.hasher.words(text, self.begin, self.begin + self.length)
            self.order = np.argsort(hashes)
            self.sieve = Sieve(hashes)
            if len(self.sieve.sorted) == len(terms):
                return
        raise ValueError("terms repeat")

    def find(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the words that are terms, their terms)."""
        at, rank = self.sieve.find(self.hasher.words(text, begin, end))
        term = self.order[rank]
        same = end[at] - begin[at] == self.length[term]
        at, term = at[same], term[same]
        if len(at):
            length = self.length[term]
            equal = text[slices(begin[at], length)] == self.text[slices(self.begin[term], length)]
            whole = np.logical_and.reduceat(equal, np.cumsum(length) - length)
            at, term = at[whole], term[whole]
        return at, term


def postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs): every document's length and the terms it holds."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TermTable(shared.value)
        for batch in batches:
            counts, sizes, found, times = [], [], [], []
            for w in word_groups(batch.column(1)):
                at, term = table.find(w.text, w.begin, w.end)
                code, tf = np.unique(w.row[at] * table.count + term, return_counts=True)
                counts.append(w.count)
                sizes.append(np.bincount(code // table.count, minlength=len(w.count)))
                found.append(code % table.count)
                times.append(tf)
            ends = pa.array(np.cumsum(np.concatenate([[0], *sizes])).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([[], *counts]).astype(np.int64)),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate([[], *found]).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate([[], *times]).astype(np.int64)))],
                names=["doc_id", "n", "terms", "tfs"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       text_or_empty(docs["text"]).alias("text")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, tfs array<long>")


def item_terms(items: DataFrame) -> DataFrame:
    """``items`` (text last) with its distinct terms and how often each occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for w in word_groups(batch.column(batch.num_columns - 1)):
                text = w.text.tobytes()
                for r in range(len(w.count)):
                    at = range(int(w.first[r]), int(w.first[r + 1]))
                    rows.append(Counter(text[w.begin[i]:w.end[i]] for i in at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([list(r.keys()) for r in rows], pa.list_(pa.binary())),
                 pa.array([list(r.values()) for r in rows], pa.list_(pa.int64()))],
                names=[*batch.schema.names, "terms", "repeats"])

    bound_batches(items.sparkSession)
    schema = T.StructType([*items.schema.fields, T.StructField("terms", T.ArrayType(T.BinaryType())),
                           T.StructField("repeats", T.ArrayType(T.LongType()))])
    return items.mapInArrow(run, schema)


# -- best positions ---------------------------------------------------------------

class ImpactLists:
    """Impact lists over some documents: list t holds the documents of term t by
    falling impact, at the places ``start[t]`` to ``start[t + 1]``. A document's
    own entries stand together as well (``first``, ``term``, ``place``)."""

    def __init__(self, term: np.ndarray, impact: np.ndarray, size: np.ndarray, terms: int):
        doc = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((doc, -impact, term))
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.term, self.impact = term, impact
        self.place = np.empty(len(term), np.int64)
        self.place[order] = np.arange(len(term))
        self.doc, self.by_place = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(terms + 1))
        self.seen = np.zeros(len(term), bool)
        self.met = np.zeros(len(size), bool)

    def search(self, terms: np.ndarray, factor: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """Bring the best documents of one query into ``best``. ``factor``: of
        each of ``terms``; ``weight``: zeros by term, for use meanwhile."""
        full = self.start[terms + 1] > self.start[terms]
        terms, factor = terms[full & (factor > 0)], factor[full & (factor > 0)]
        at, stop = self.start[terms].copy(), self.start[terms + 1]
        weight[terms] = factor
        touched, met, step = [], [], FIRST_STEP
        while True:
            open_ = at < stop
            ahead = int((factor[open_] * self.by_place[at[open_]]).sum())
            if not open_.any() or best.full_above(ahead):
                break
            reach = np.minimum(at + step, stop)
            places = slices(at, reach - at)
            docs = self.doc[places[~self.seen[places]]]
            docs = np.unique(docs[~self.met[docs]])
            self.met[docs] = True
            met.append(docs)
            size = self.first[docs + 1] - self.first[docs]
            entry = slices(self.first[docs], size)
            worth = weight[self.term[entry]]
            score = np.add.reduceat(worth * self.impact[entry], np.cumsum(size) - size) if len(docs) else worth
            best.add(score, docs)
            own = self.place[entry[worth > 0]]              # seen in all lists at once
            self.seen[own] = True
            touched.append(own)
            at = self._best_positions(reach, stop, step)
            step = min(step * 2, LAST_STEP)
        weight[terms] = 0
        for x in touched:
            self.seen[x] = False
        for x in met:
            self.met[x] = False

    def _best_positions(self, at: np.ndarray, stop: np.ndarray, step: int) -> np.ndarray:
        """First unseen place of each list from ``at`` on."""
        reach, todo = np.arange(step), np.flatnonzero(at < stop)
        while len(todo):
            places = at[todo, None] + reach
            inside = places < stop[todo, None]
            ran = (self.seen[np.minimum(places, len(self.seen) - 1)] & inside)
            go = np.where(ran.all(axis=1), step, ran.argmin(axis=1))
            at[todo] += go
            todo = todo[(go == step) & (at[todo] < stop[todo])]
        return at


class Best:
    """The k best (score, id) so far, across the batches of a task."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        self.ids = self.nulls = None

    def batch(self, ids: np.ndarray, nulls: np.ndarray) -> Best:
        self.ids, self.nulls = ids, nulls
        return self

    def full_above(self, bound: int) -> bool:
        return len(self.score) == self.k and int(self.score[-1]) > bound

    def add(self, score: np.ndarray, docs: np.ndarray) -> None:
        bar = self.score[-1] if len(self.score) == self.k else 1
        keep = score >= max(1, bar)
        score = np.concatenate([self.score, score[keep]])
        ids = np.concatenate([self.id, self.ids[docs[keep]]])
        null = np.concatenate([self.null, self.nulls[docs[keep]]])
        top = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.id, self.null = score[top], ids[top], null[top]


def impacts(n: np.ndarray, tf: np.ndarray, docs: int, length: int) -> np.ndarray:
    """Impact of a term that occurs tf times in a document of n terms."""
    m = 25 + (75 * n * docs) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _search(rows: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], terms: int, docs: int,
            length: int, k: int) -> DataFrame:
    """(query, doc_id, score): each task's k best of every query."""
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best = [Best(k) for _ in asked]
        weight = np.zeros(terms, np.int64)
        for batch in batches:
            ids = batch.column(0)
            nulls = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            size = np.diff(batch.column(2).offsets.to_numpy()).astype(np.int64)
            tf = batch.column(3).flatten().to_numpy()
            impact = impacts(np.repeat(batch.column(1).to_numpy(), size), tf, docs, length)
            lists = ImpactLists(batch.column(2).flatten().to_numpy().astype(np.int64), impact, size, terms)
            for (own, factor), top in zip(asked, best):
                lists.search(own, factor, weight, top.batch(ids, nulls))
        for q, top in enumerate(best):
            if len(top.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top.score), q, np.int32)),
                     pa.array(top.id, pa.int64(), mask=top.null), pa.array(top.score)],
                    names=["query", "doc_id", "score"])

    return rows.filter(F.size("terms") > 0).mapInArrow(run, "query int, doc_id long, score long")


def _rounds(items: DataFrame, size: int) -> Iterator[list]:
    """The items' rows, block by block."""
    rows = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = max(1, -(-rows // size))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        yield (items if n == 1 else items.filter(part == i)).select("item_id", "terms", "repeats").collect()


def search(docs: DataFrame, items: DataFrame, k: int = NEAREST, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           block: int = TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above
    zero for every item."""
    spark = docs.sparkSession
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    asked = items.select(items[item_col].alias("item_id"), text_or_empty(items[item_text]).alias("text")).distinct()
    asked = materialize(item_terms(asked).filter(F.size("terms") > 0), "items")
    kind = asked.schema["item_id"].dataType
    found = [_round(spark, docs, rows, kind, k) for rows in _rounds(asked, block) if rows]
    if not found:
        return spark.createDataFrame([], T.StructType([
            T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return reduce(DataFrame.unionByName, found)


def _round(spark: SparkSession, docs: DataFrame, rows: list, kind: T.DataType, k: int) -> DataFrame:
    terms = sorted({bytes(t) for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(terms)}
    held = materialize(postings(docs, terms), "postings")
    n_docs, length = held.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = dict(held.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weight = np.zeros(len(terms), np.int64)
    for t, n in df.items():
        weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
    queries = []
    for r in rows:
        own = np.array([number[bytes(t)] for t in r["terms"]], np.int64)
        queries.append((own, np.array(r["repeats"], np.int64) * weight[own]))
    tops = _search(held, queries, len(terms), n_docs, length or 1, k)
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = tops.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], T.StructType([
        T.StructField("query", T.IntegerType()), T.StructField("item_id", kind)]))
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
