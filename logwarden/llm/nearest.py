"""Nearest neighbours by a blocked matrix join (operator 8).

Queries and candidates are dealt into a grid of tiles; the tile count follows
from the row counts, so a tile's size does not grow with the data. In a tile
all vectors are scaled to length one and quantised to int8. One matrix product
of the int8 values gives every cosine up to a proven error: with q = q' + e the
product of two unit vectors differs from that of their quantised forms by at
most |e_q| + |e_c| |q'|. A candidate survives if its upper bound reaches the
k-th best lower bound of the query; the survivors' cosines are computed again
from the original vectors in double precision and the best k are held in a
heap. The tiles' heaps merge into the k nearest overall. The search is exact.

Defined results: vectors that are null, of length zero, empty, or hold null or
non-finite components take no part; vectors of different sizes are never
compared; equal scores go to the smaller id; repeated rows are candidates of
their own, except that a query leaves out every row with its own id; null ids
take no part; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches

NEAREST = 5
QUERY_STEP = 50
#: Rows of a tile: queries, candidates.
TILE_QUERIES, TILE_CANDIDATES = 4096, 16384
#: Queries that one product takes.
STRIP = 128
#: Room for rounding in the float products, far above double precision's own.
ROUNDING = 1e-9


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vec_col).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite
        & F.exists(v, lambda x: x != 0))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, and length of the error of each row."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, error


def even(rows: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component to 1 or
    just above: exact (but for components that no sum could tell), and squares
    neither vanish nor overflow."""
    _, power = np.frexp(np.abs(rows).max(axis=-1, keepdims=True))
    return np.ldexp(rows, 1 - power)


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, in double precision (each row summed
    on its own from its first component on, so a score does not depend on the
    tile)."""
    query, rows = even(query), even(rows)

    def total(x: np.ndarray) -> np.ndarray:
        return np.cumsum(x, axis=-1)[..., -1]

    return total(rows * query) / (np.sqrt(total(rows * rows)) * np.sqrt(total(query * query)))


def search_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray,
                k: int) -> Iterator[tuple[int, int, float]]:
    """(query, candidate, score) of each query's k nearest in the tile."""
    def unit(x: np.ndarray) -> np.ndarray:
        x = even(x)
        return x / np.linalg.norm(x, axis=1)[:, None]

    c8, c_scale, c_error = quantise(unit(c))
    q8, q_scale, q_error = quantise(unit(q))
    # Sums of int8 products are whole numbers: exact in float32 below 2**24.
    exact = np.float32 if c.shape[1] * 127 * 127 < 1 << 24 else np.float64
    turned = c8.astype(exact).T
    for at in range(0, len(q_ids), STRIP):
        rows = slice(at, at + STRIP)
        near = (q8[rows].astype(exact) @ turned) * q_scale[rows, None] * c_scale
        slack = q_error[rows, None] + c_error * (1 + q_error[rows, None]) + ROUNDING
        own = q_ids[rows, None] == c_ids
        low, high = near - slack, near + slack
        low[own], high[own] = -np.inf, -np.inf
        if len(c_ids) > k:
            bar = -np.partition(-low, k - 1, axis=1)[:, k - 1]
        else:
            bar = np.full(len(low), -np.inf)
        for i in range(len(low)):
            alive = np.flatnonzero((high[i] >= bar[i]) & ~own[i])
            score = cosines(q[at + i], c[alive])
            best = heapq.nsmallest(k, zip((-score).tolist(), c_ids[alive].tolist()))
            for s, cid in best:
                yield int(q_ids[at + i]), cid, -s


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the
    largest cosine for every row of ``queries``."""
    bound_batches(vectors.sparkSession)
    every, asked = usable(vectors, id_col, vec_col), usable(queries, id_col, vec_col)
    n_c, n_q = every.count(), asked.count()
    across = max(1, -(-n_c // TILE_CANDIDATES))
    down = max(1, -(-n_q // TILE_QUERIES))
    spread = F.xxhash64("id", "v")
    # Each side gets a place on its axis and is repeated along the other one.
    c = every.select("id", "v", F.size("v").alias("dim"), F.pmod(spread, F.lit(across)).alias("x"),
                     F.explode(_range(down)).alias("y"))
    q = asked.select("id", "v", F.size("v").alias("dim"), F.pmod(spread, F.lit(down)).alias("y"),
                     F.explode(_range(across)).alias("x"))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            (q_ids, qv), (c_ids, cv) = _matrix(left), _matrix(right)
            found = list(search_tile(q_ids, qv, c_ids, cv, k))
        a, b, s = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()),
                         "score": pa.array(s, pa.float64())})

    keys = ("y", "x", "dim")
    heaps = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(
        tile, "query_id long, vec_id long, score double")

    # Each task first cuts its tiles' heaps of a query to k rows (Spark limits
    # the groups of a ranked window before the shuffle), so no query gathers
    # more than k rows from a task.
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return heaps.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _range(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    rows = rows.combine_chunks()
    ids = rows.column("id").to_numpy()
    v = rows.column("v").chunk(0)
    return ids, v.flatten().to_numpy().reshape(len(ids), -1)


def self_search(vectors: DataFrame, step: int = QUERY_STEP, k: int = NEAREST,
                id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Queries: the rows whose id is divisible by ``step``."""
    return nearest(vectors, vectors.filter(F.col(id_col) % step == 0), k, id_col, vec_col)
