"""SimHash near-duplicates through a Gray-order hierarchical index (operator 2).

Fingerprints that differ in at most three bits agree on at least one of their
four 16-bit blocks. For each block in turn the distinct fingerprints are
rotated so that the block leads, and sorted by Gray rank (neighbours in that
order differ in few bits, and equal leading blocks stand together). Runs with
the same block are cut into nodes of up to NODE rows, these into leaves of up
to LEAF rows. A node or leaf keeps the bits on which all its rows agree; the
differences of two agreed patterns are a lower bound for all pairs below them.
The bound accumulates from nodes over leaves to rows, and a whole group is left
out as soon as it passes the limit. Each comparison of two groups yields a
spanning forest of its links rather than all pairs, so copies do not multiply.

Defined results: null text counts as empty; a text without words has
fingerprint zero and links like any other; repeated rows and null ids keep a
row each (a null id is never a component's smallest); extra columns are
ignored by ``near_duplicates``; an empty table gives no rows; texts of any
length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, materialize, text_or_empty
from .components import components
from .word_ids import column_bytes, row_groups, slices, word_bounds

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCKS = 4
NODE, LEAF = 256, 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def shingle_bytes(data: np.ndarray, offsets: np.ndarray, size: int):
    """Words of each row, lower-cased and single-spaced: (bytes, start and end
    of every shingle, row of every shingle). A row with fewer words gives all
    of them as one shingle; a row without words gives none."""
    starts, ends = word_bounds(data, offsets)
    length = ends - starts
    # each word with the byte after it, which becomes the space
    text = _LOWER[data[np.minimum(slices(starts, length + 1), len(data) - 1)]]
    end = np.cumsum(length + 1) - 1             # of each word in ``text``
    text[end] = 32
    begin = end - length
    first = np.searchsorted(starts, offsets)
    words = np.diff(first)
    shingles = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    row = np.repeat(np.arange(len(words)), shingles)
    head = slices(first[:-1], shingles)
    tail = np.minimum(head + size, first[1:][row]) - 1
    return text, begin[head], end[tail], row


def fingerprints(column: pa.Array, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """SimHash of every row of a string column."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    data, offsets = column_bytes(column)
    out = []
    for a, b in row_groups(offsets):
        base = offsets[a]
        text, start, end, row = shingle_bytes(data[base:offsets[b]], offsets[a:b + 1] - base, size)
        raw = text.tobytes()
        h = np.fromiter((digest(raw[s:e], seed) for s, e in zip(start.tolist(), end.tolist())),
                        np.uint64, len(start))
        octets = h.view(np.uint8).reshape(-1, 8)             # little-endian: low byte first
        n, cell = b - a, row * 256
        half = np.bincount(row, minlength=n)[:, None]
        mark = np.zeros(n, np.uint64)
        for k in range(8):
            seen = np.bincount(cell + octets[:, k], minlength=n * 256).reshape(n, 256)
            on = 2 * (seen @ _BITS) > half
            mark |= (on.astype(np.uint64) << np.arange(8 * k, 8 * k + 8, dtype=np.uint64)).sum(
                axis=1, dtype=np.uint64)
        out.append(mark)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     size: int = SHINGLE) -> DataFrame:
    """(id, fp long) of every text."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints(batch.column(1), size).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], text_or_empty(docs[text_col]).alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, fp long")


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit value in the Gray sequence, as a signed long that
    sorts like the unsigned rank."""
    for n in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, n))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def _rotated(block: int) -> Column:
    fp, left = F.col("fp"), 16 * block
    return fp if not left else F.shiftleft(fp, left).bitwiseOR(F.shiftrightunsigned(fp, 64 - left))


# -- the index ----------------------------------------------------------------

def agreed(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask of the bits on which each group agrees, those bits) for groups
    that begin at ``first``."""
    every = np.bitwise_and.reduceat(values, first)
    some = np.bitwise_or.reduceat(values, first)
    mask = ~(every ^ some)
    return mask, every & mask


def linked_rows(left: np.ndarray, right: np.ndarray, pairs: np.ndarray, limit: int) -> np.ndarray:
    """Row pairs (i in left, j in right) within ``limit`` among leaf pairs.
    ``pairs``: start and end of the left leaf, start and end of the right."""
    found = [np.zeros((0, 2), np.int64)]
    step = np.arange(LEAF)
    for at in range(0, len(pairs), 4096):
        p = pairs[at:at + 4096]
        a, b = p[:, :1] + step, p[:, 2:3] + step
        real = (a < p[:, 1:2])[:, :, None] & (b < p[:, 3:4])[:, None, :]
        apart = np.bitwise_count(left[np.minimum(a, len(left) - 1)][:, :, None]
                                 ^ right[np.minimum(b, len(right) - 1)][:, None, :])
        k, i, j = np.nonzero(real & (apart <= limit))
        found.append(np.stack([a[k, i], b[k, j]], 1))
    return np.concatenate(found)


def forest(n: int, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(child, root) rows of a star forest with the components of ``links``."""
    label = np.arange(n)
    while len(links):
        low = np.minimum(label[links[:, 0]], label[links[:, 1]])
        before = label.copy()
        for side in (0, 1):
            np.minimum.at(label, before[links[:, side]], low)
            np.minimum.at(label, links[:, side], low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    child = np.flatnonzero(label != np.arange(n))
    return child, label[child]


def leaves(starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row ranges cut into parts of up to ``size``: starts, ends, owner."""
    n = -(-(ends - starts) // size)
    owner = np.repeat(np.arange(len(starts)), n)
    at = starts[owner] + size * slices(np.zeros(len(n), np.int64), n)
    return at, np.minimum(at + size, ends[owner]), owner


def links_within(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int) -> np.ndarray:
    """Row pairs within ``limit`` inside each node; nodes cover all rows."""
    low, high, node = leaves(starts, ends, LEAF)
    mask, bits = agreed(values, low)
    alone = np.flatnonzero(high - low > 1)
    pairs = [np.stack([low[alone], high[alone], low[alone], high[alone]], 1)]
    for step in range(1, NODE // LEAF):
        a = np.arange(len(low) - step)
        a = a[node[a] == node[a + step]]
        if not len(a):
            break
        apart = np.bitwise_count((bits[a] ^ bits[a + step]) & mask[a] & mask[a + step])
        a = a[apart <= limit]                    # the rest of the group is left out
        pairs.append(np.stack([low[a], high[a], low[a + step], high[a + step]], 1))
    found = linked_rows(values, values, np.concatenate(pairs), limit)
    return found[found[:, 0] < found[:, 1]]


def links_between(left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
    """Row pairs within ``limit`` between two nodes: the nodes' agreed
    difference, then each leaf pair's further difference, then rows."""
    whole = np.zeros(1, np.int64)
    (lm, lb), (rm, rb) = agreed(left, whole), agreed(right, whole)
    both = lm & rm
    apart = np.bitwise_count((lb ^ rb) & both).astype(np.int64)
    if apart[0] > limit:
        return np.zeros((0, 2), np.int64)
    a, a_end, _ = leaves(whole, np.array([len(left)]), LEAF)
    b, b_end, _ = leaves(whole, np.array([len(right)]), LEAF)
    (am, ab), (bm, bb) = agreed(left, a), agreed(right, b)
    more = np.bitwise_count((ab[:, None] ^ bb[None, :]) & am[:, None] & bm[None, :] & ~both)
    i, j = np.nonzero(apart + more <= limit)
    return linked_rows(left, right, np.stack([a[i], a_end[i], b[j], b_end[j]], 1), limit)


def index_chunk(rows: list[tuple[np.ndarray, ...]], chunk: int, limit: int) -> dict[str, list]:
    """Links inside the nodes of a stretch of sorted rows, and the nodes that
    other nodes may have to be held against (runs of several nodes, and the
    first and last run, which may go on in another stretch)."""
    block, key, fp = (np.concatenate(c) for c in zip(*rows))
    values = fp.view(np.uint64)
    new = np.r_[True, (block[1:] != block[:-1]) | (key[1:] != key[:-1])]
    run = np.flatnonzero(new)
    run_end = np.r_[run[1:], len(fp)]
    low, high, owner = leaves(run, run_end, NODE)
    child, root = forest(len(fp), links_within(values, low, high, limit))
    mask, bits = agreed(values, low)
    several = np.bincount(owner) > 1
    several[[0, -1]] = True
    kept = np.flatnonzero(several[owner])
    none = [None] * len(kept)
    out = {"a": [*fp[child].tolist(), *none], "b": [*fp[root].tolist(), *none]}
    n = [None] * len(child)
    out["block"] = n + block[low[kept]].tolist()
    out["key"] = n + key[low[kept]].tolist()
    out["node"] = n + [(chunk << 20) + k for k in kept.tolist()]
    out["mask"] = n + mask[kept].view(np.int64).tolist()
    out["bits"] = n + bits[kept].view(np.int64).tolist()
    out["rows"] = n + [fp[low[k]:high[k]].tobytes() for k in kept.tolist()]
    return out


#: Rows of a stretch of the index, and distinct fingerprints for each sort task.
STRETCH, PER_TASK = 1 << 15, 1 << 18

_INDEX_SCHEMA = ("a long, b long, block int, key int, node long, mask long, bits long, rows binary")


def fingerprint_links(fps: DataFrame, limit: int = DISTANCE) -> DataFrame:
    """(a, b) links between the distinct fingerprints of ``fps`` (column fp):
    the same components as all pairs within ``limit`` bits (at most 3)."""
    if not 0 <= limit < BLOCKS:
        raise ValueError(f"the index finds distances below {BLOCKS}")
    from pyspark import TaskContext

    n = fps.count()
    tables = F.explode(F.array(*[F.struct(
        F.lit(t).alias("block"), F.shiftrightunsigned(_rotated(t), 48).cast("int").alias("key"),
        gray_rank(_rotated(t)).alias("rank")) for t in range(BLOCKS)]))
    entries = fps.select("fp", tables.alias("e")).select("e.block", "e.key", "e.rank", "fp")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, held, count = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            found = index_chunk(held, (part << 20) + chunk, limit)
            return pa.RecordBatch.from_pydict(found, schema=pa.schema([
                ("a", pa.int64()), ("b", pa.int64()), ("block", pa.int32()), ("key", pa.int32()),
                ("node", pa.int64()), ("mask", pa.int64()), ("bits", pa.int64()),
                ("rows", pa.binary())])).select(["a", "b", "block", "key", "node", "mask", "bits", "rows"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            count += batch.num_rows
            if count >= STRETCH:
                yield flush()
                chunk, held, count = chunk + 1, [], 0
        if held:
            yield flush()

    tasks = max(1, -(-n * BLOCKS // PER_TASK))
    index = materialize(entries.repartitionByRange(tasks, "block", "rank").sortWithinPartitions(
        "block", "rank").select("block", "key", "fp").mapInArrow(build, _INDEX_SCHEMA), "gray-index")
    nodes = index.filter("rows is not null").select("block", "key", "node", "mask", "bits", "rows")
    left = nodes.select("block", "key", *[F.col(c).alias(f"l_{c}") for c in ("node", "mask", "bits", "rows")])
    differ = F.bit_count(F.col("bits").bitwiseXOR(F.col("l_bits")).bitwiseAND(
        F.col("mask")).bitwiseAND(F.col("l_mask")))
    met = nodes.join(left, ["block", "key"]).filter(
        (F.col("l_node") < F.col("node")) & (differ <= limit)).select("l_rows", "rows")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                links = links_between(x.view(np.uint64), y.view(np.uint64), limit)
                child, root = forest(len(x) + len(y), links + [0, len(x)])
                both = np.concatenate([x, y])
                a += both[child].tolist()
                b += both[root].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])

    return index.filter("a is not null").select("a", "b").unionByName(
        met.mapInArrow(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SHINGLE, limit: int = DISTANCE) -> DataFrame:
    """(id, fingerprint, component_id): component_id is the smallest id that
    links of at most ``limit`` bits reach."""
    marked = materialize(with_fingerprint(docs, id_col, text_col, size), "fingerprints")
    classes = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("first")), "classes")
    roots = components(fingerprint_links(classes.select("fp"), limit), "a", "b")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    smallest = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")),
                           "component-ids")
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             size: int = SHINGLE, limit: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the one with
    the smallest id, and of rows that share it the one whose text has the least
    hash. A null id counts as a negative number made from its text; of rows with
    equal id and text one stays."""
    mark = "__row_id"
    while mark in docs.columns:
        mark += "_"
    text = F.xxhash64(text_or_empty(text_col))
    own = F.coalesce(F.col(f"`{id_col}`").cast("long"), -text.bitwiseAND(F.lit((1 << 63) - 1)) - 1)
    rows = docs.withColumn(mark, F.struct(own.alias("id"), text.alias("text")))
    kept = near_duplicates(rows, mark, text_col, size, limit).filter(
        F.col(mark) == F.col("component_id")).select(mark).distinct()
    return rows.join(kept, mark).dropDuplicates([mark]).select(*[F.col(f"`{c}`") for c in docs.columns])
