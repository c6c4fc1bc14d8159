"""Removal of repeated 100-byte strings by a column-wise built collection
Burrows-Wheeler transform (operator 7).

Every byte is removed that lies in a string of LENGTH bytes which also starts
earlier (smaller id, or same document and earlier start), judged on the input.

Sorting all suffixes of a large corpus together is not needed: two equal
strings hold the same least GRAM-byte gram at the same place (an anchor), so
strings are only held against those with an equal anchor gram.

1. Each task finds the anchors of its documents and, for each, the range of
   strings that it stands for. Anchors with the same surroundings as an earlier
   one of the same batch are settled there, so copies do not reach a shuffle.
   Both kinds are written in one pass over the texts.
2. The others meet by gram. Equal surroundings leave only the earliest.
3. Where one gram has several surroundings, these form a collection of short
   strings. Its Burrows-Wheeler transform and common prefixes are built column
   by column from the right: each round inserts one symbol of every string (a
   stable sort of the transform gives the next order) and updates the common
   prefixes. After the round of a column, strings that begin there are equal
   where the common prefix is LENGTH or more. Columns lie one after the other in
   memory and are read in sequence; a collection has a bounded size.
4. Grams with more than CROWD surroundings are not collected into one task:
   their strings meet by a hash of their own content.

Defined results: null text counts as empty; texts shorter than LENGTH lose
nothing; null ids count as larger than all others; rows that share an id are
not earlier than each other at the same start (so repeated rows have equal
results); extra columns are ignored; an empty table gives no rows; texts are
bytes of UTF-8, of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (bound_batches, drop_scratch, materialize, release, shared_keys, text_hash,
                     text_or_empty)
from .word_ids import Hasher, column_bytes, mix, row_groups

LENGTH = 100
GRAM = 32
#: Bytes to the left of an anchor that its strings can take in.
REACH = LENGTH - GRAM
#: Bytes of text handled in one array pass (positions must fit 20 bits).
STRETCH = 1 << 20
#: Surroundings of one gram that go into one collection.
CROWD = 4096
#: Strings of one collection (whole grams are added until it is reached).
COLLECTION = 1 << 16
LAST_ID = (1 << 63) - 1

_WIDTH = REACH + LENGTH


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every ``width`` neighbours."""
    n = len(keys)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


class Anchors:
    """Anchors of a stretch of rows."""

    def __init__(self):
        self.hasher = Hasher()

    def column(self, column: pa.Array) -> dict[str, np.ndarray]:
        """row, pos, near, far (least and largest distance from a string's
        start to the anchor), gram, around (hash of the surroundings)."""
        data, offsets = column_bytes(column)
        found = []
        for a, b in row_groups(offsets, STRETCH // 2):
            base, size = int(offsets[a]), int(offsets[b] - offsets[a])
            if size <= STRETCH:
                f = self.stretch(data[base:base + size], offsets[a:b + 1] - base)
                f["row"] += a
                found.append(f)
                continue
            for at in range(0, size - LENGTH + 1, STRETCH - LENGTH):   # one long row
                part = data[base + at:base + min(size, at + STRETCH - 1)]
                f = self.stretch(part, np.array([0, len(part)]))
                f["row"] += a
                f["pos"] += at
                found.append(f)
        names = ("row", "pos", "near", "far", "gram", "around")
        if not found:
            return {k: np.zeros(0, np.uint64 if k in ("gram", "around") else np.int64) for k in names}
        return {k: np.concatenate([f[k] for f in found]) for k in names}

    def stretch(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        n = len(data)
        none = np.zeros(0, np.int64)
        if n < LENGTH:
            return {"row": none, "pos": none, "near": none, "far": none,
                    "gram": none.astype(np.uint64), "around": none.astype(np.uint64)}
        sums = self.hasher.sums(data)
        at = np.arange(n - GRAM + 1)
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * self.hasher.inverse[:len(at)])
        # The place breaks ties, so equal strings choose alike.
        least = sliding_least((grams & ~np.uint64(STRETCH - 1)) | at.astype(np.uint64), REACH + 1)
        row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        start = np.flatnonzero(row_of[:n - LENGTH + 1] == row_of[LENGTH - 1:])
        if not len(start):
            return self.stretch(data[:0], offsets[:1])
        anchor = (least[start] & np.uint64(STRETCH - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
        last = np.r_[first[1:], len(start)] - 1
        p, low, high = anchor[first], start[first], start[last]
        near, far = p - high, p - low
        around = mix(self.hasher.ranges(sums, low, high + LENGTH)
                     + (near * 256 + far).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        row = row_of[low]
        return {"row": row, "pos": p - offsets[row], "near": near, "far": far,
                "gram": grams[p], "around": around}


def pack(pos: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    return (pos << 16) | (near << 8) | far


def batch_anchors(finder: Anchors, batch: pa.RecordBatch):
    """(anchors, ids, text hashes, packed places) of a batch (id, text, tag)."""
    f = finder.column(batch.column(1))
    ids, tags = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 2))
    row = f["row"]
    return f, ids[row], tags[row], pack(f["pos"], f["near"], f["far"])


def earliest(f: dict, ids: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each (gram, around), later ones) as index arrays."""
    order = np.lexsort((packed, ids, f["around"], f["gram"]))
    g, c, i, p = (x[order] for x in (f["gram"], f["around"], ids, packed >> 16))
    new = np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])] if len(g) else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
    later = (i != i[head]) | (p != p[head])
    return order[new], order[later]


def _gaps(ids: np.ndarray, tag: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
    """Removed byte ranges (id, tag, first, stop) of whole anchors, merged."""
    pos, near, far = packed >> 16, packed >> 8 & 0xFF, packed & 0xFF
    first, stop = pos - far, pos - near + LENGTH
    order = np.lexsort((first, tag, ids))
    ids, tag, first, stop = (x[order] for x in (ids, tag, first, stop))
    if len(ids):
        begin = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (tag[1:] != tag[:-1])
                                     | (first[1:] > stop[:-1])])
        # ranges of one document grow to the right, so a run ends with its last stop
        ids, tag, first = ids[begin], tag[begin], first[begin]
        stop = np.maximum.reduceat(stop, begin)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(tag), pa.array(first), pa.array(stop)],
        names=["id", "tag", "first", "stop"])


_GAPS = "id long, tag long, first long, stop long"


def collection_classes(strings: np.ndarray, near: np.ndarray, far: np.ndarray,
                       rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeated strings of a collection of surroundings (rows of _WIDTH bytes,
    anchor at REACH). ``rank`` orders the rows by id and place. Per row the
    nearest and farthest repeated string (distance of its start to the anchor),
    or -1: a string is repeated if a row of smaller rank holds it too."""
    m, width = strings.shape
    columns = np.ascontiguousarray(strings.T)      # one column after the other
    order = np.arange(m)
    common = np.zeros(m, np.int64)                 # with the row before, in order
    low, high = np.full(m, -1, np.int64), np.full(m, -1, np.int64)
    for column in range(width - 1, -1, -1):
        transform = columns[column][order]         # symbols before the sorted suffixes
        step = np.argsort(transform, kind="stable")
        common = _extended(common, transform, step)
        order = order[step]
        distance = REACH - column
        if distance < 0:
            continue
        inside = (near[order] <= distance) & (distance <= far[order])
        run = np.cumsum(common < LENGTH) - 1
        best = np.full(run[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(best, run[inside], rank[order[inside]])
        again = order[inside & (rank[order] > best[run])]
        low[again] = np.where(low[again] < 0, distance, low[again])
        high[again] = distance
    return low, high


def _extended(common: np.ndarray, transform: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Common prefixes after inserting a symbol before every suffix: neighbours
    with the same symbol have one more than the least between their old places."""
    out = np.zeros(len(step), np.int64)
    symbol = transform[step]
    same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
    if len(same):
        out[same] = 1 + _least_between(common, step[same - 1] + 1, step[same] + 1)
    return out


def _least_between(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """min(values[start:stop]) of each range, from minima of doubling spans."""
    level = np.frexp(stop - start)[1] - 1
    out = np.empty(len(start), np.int64)
    table = values
    for k in range(int(level.max()) + 1):
        if k:
            table = np.minimum(table[:-(1 << (k - 1))], table[1 << (k - 1):])
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[start[at]], table[stop[at] - (1 << k)])
    return out


def _surroundings(texts: list[bytes], pos: np.ndarray) -> np.ndarray:
    """Bytes from REACH before to LENGTH after each position, zero outside."""
    out = np.zeros((len(pos), _WIDTH), np.uint8)
    for k, (t, p) in enumerate(zip(texts, pos.tolist())):
        a, b = max(0, p - REACH), min(len(t), p + LENGTH)
        out[k, a - p + REACH:b - p + REACH] = np.frombuffer(t, np.uint8, b - a, a)
    return out


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tag, first, stop): byte ranges to remove; they may overlap. tag is
    a 64-bit hash of the text, so that rows sharing an id stay apart.

    The ranges are written and the tables that led to them deleted; each step's
    shuffle files go before the next step makes its own, so what is on disk at
    once is one step and not their sum."""
    bound_batches(docs.sparkSession)
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
                        text_or_empty(text_col).alias("text")).withColumn("tag", text_hash("text"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors()
        for batch in batches:
            f, ids, tags, packed = batch_anchors(finder, batch)
            at, later = earliest(f, ids, packed)
            done = _gaps(ids[later], tags[later], packed[later])
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(f["gram"][at].view(np.int64)), pa.array(f["around"][at].view(np.int64)),
                 pa.array(ids[at]), pa.array(tags[at]), pa.array(packed[at]), none, none],
                names=names)
            none = pa.nulls(done.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, done.column(0), done.column(1), none, done.column(2), done.column(3)],
                names=names)

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _gaps(*(batch.column(k).to_numpy() for k in range(3)))

    # One written pass: what a batch settles and what it leaves agree whatever
    # order its rows come in, and a lost executor re-reads both.
    names = ["gram", "around", "id", "tag", "packed", "first", "stop"]
    found = materialize(keyed.mapInArrow(anchors, ", ".join(f"{c} long" for c in names)), "anchors")
    here = materialize(found.filter("gram is null").select("id", "tag", "first", "stop"), "settled")
    open_ = found.filter("gram is not null").drop("first", "stop")
    met = materialize(shared_keys(open_, "gram").drop("n"), "met-grams")
    drop_scratch(found)
    place = F.struct("id", F.shiftright("packed", 16).alias("pos"))
    firsts = met.groupBy("gram", "around").agg(F.min(F.struct("id", "packed", "tag")).alias("first"))
    later = met.join(firsts, ["gram", "around"]).filter(
        place > F.struct("first.id", F.shiftright("first.packed", 16).alias("pos"))).select("id", "tag", "packed")
    contested = materialize(shared_keys(firsts.select("gram", "first.*"), "gram"),
                            "contested")
    release(docs.sparkSession)
    strings = materialize(_with_surroundings(keyed, contested), "surroundings")
    release(docs.sparkSession)
    small = strings.filter(F.col("n") <= CROWD).repartition("gram").sortWithinPartitions("gram")
    crowded = strings.filter(F.col("n") > CROWD)
    ranges = materialize(
        here.unionByName(later.mapInArrow(gaps, _GAPS))
        .unionByName(small.select("gram", "id", "tag", "packed", "string").mapInArrow(_collections, _GAPS))
        .unionByName(_by_content(crowded)), "repeated-ranges")
    drop_scratch(here, met, contested, strings)
    return ranges


def _with_surroundings(keyed: DataFrame, contested: DataFrame) -> DataFrame:
    """(gram, n, id, tag, packed, string) of contested anchors; their documents'
    texts are looked up by id and tag."""
    wanted = contested.groupBy("id", "tag").agg(
        F.collect_list(F.struct("gram", "n", "packed")).alias("anchors"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(2).value_lengths().fill_null(0))
            flat = batch.column(2).flatten()
            packed = flat.field("packed").to_numpy()
            raw = [t.encode() for t in batch.column(1).to_pylist()]
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            strings = _surroundings([raw[o] for o in owner.tolist()], packed >> 16)
            yield pa.RecordBatch.from_arrays(
                [flat.field("gram"), flat.field("n"), batch.column(0).take(pa.array(owner)),
                 batch.column(3).take(pa.array(owner)), flat.field("packed"), pa.array([s.tobytes() for s in strings], pa.binary())],
                names=["gram", "n", "id", "tag", "packed", "string"])

    return keyed.join(wanted, ["id", "tag"]).select("id", "text", "anchors", "tag").mapInArrow(
        cut, "gram long, n long, id long, tag long, packed long, string binary").dropDuplicates(
            ["gram", "id", "tag", "packed"])


def _collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed ranges from collections of whole grams (rows sorted by gram)."""
    held: list[pa.RecordBatch] = []

    def solve(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        ids, tags, packed = (rows.column(c).to_numpy() for c in ("id", "tag", "packed"))
        raw = b"".join(rows.column("string").to_pylist())
        strings = np.frombuffer(raw, np.uint8).reshape(len(ids), _WIDTH)
        place = np.lexsort((packed >> 16, ids))
        step = np.r_[0, (ids[place][1:] != ids[place][:-1])
                     | ((packed >> 16)[place][1:] != (packed >> 16)[place][:-1])]
        rank = np.empty(len(ids), np.int64)
        rank[place] = np.cumsum(step)              # equal places have equal ranks
        low, high = collection_classes(strings, packed >> 8 & 0xFF, packed & 0xFF, rank)
        hit = np.flatnonzero(high >= 0)
        return _gaps(ids[hit], tags[hit], packed[hit] >> 16 << 16 | low[hit] << 8 | high[hit])

    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= COLLECTION:
            table = pa.Table.from_batches(held)
            grams = table.column("gram").to_numpy()
            cut = int(np.searchsorted(grams, grams[-1]))       # the last gram may go on
            if cut:
                yield solve(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                count = len(grams) - cut
    if held:
        yield solve(pa.Table.from_batches(held))


def _by_content(crowded: DataFrame) -> DataFrame:
    """Removed ranges of grams with very many surroundings: each string meets
    its equals by content."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(2).to_numpy()
            near, far = packed >> 8 & 0xFF, packed & 0xFF
            rows, first, keys = [], [], []
            for r, s in enumerate(batch.column(3).to_pylist()):
                for d in range(int(near[r]), int(far[r]) + 1):
                    rows.append(r)
                    first.append(int(packed[r] >> 16) - d)
                    keys.append(hashlib.blake2b(s[REACH - d:REACH - d + LENGTH], digest_size=16).digest())
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch.column(0).take(rows),
                 batch.column(1).take(rows), pa.array(first, pa.int64())],
                names=["content", "id", "tag", "first"])

    strings = crowded.select("id", "tag", "packed", "string").mapInArrow(
        spread, "content binary, id long, tag long, first long")
    least = strings.groupBy("content").agg(F.min(F.struct("id", "first")).alias("least"))
    return strings.join(least, "content").filter(F.struct("id", "first") > F.col("least")).select(
        "id", "tag", "first", (F.col("first") + LENGTH).alias("stop"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   with_bytes: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary, spans]) of
    every document."""
    ranges = repeated_ranges(docs, id_col, text_col).groupBy("id", "tag").agg(
        F.collect_list(F.struct("first", "stop")).alias("ranges"))
    keyed = docs.select(
        F.col(id_col).alias("__id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        text_or_empty(text_col).alias("text")).withColumn(
            "tag", text_hash("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, spans, digest, kept, found = [], [], [], [], [], []
            for text, held in zip(batch.column(1), batch.column(2)):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                edge = np.zeros(len(data) + 1, np.int64)
                if held.is_valid:
                    flat = held.values
                    np.add.at(edge, flat.field("first").to_numpy(), 1)
                    np.add.at(edge, flat.field("stop").to_numpy(), -1)
                covered = np.cumsum(edge)[:-1] > 0
                left = data[~covered].tobytes()
                begin = np.flatnonzero(np.diff(np.r_[False, covered].astype(np.int8)) > 0)
                size.append(len(data))
                gone.append(int(covered.sum()))
                spans.append(len(begin))
                digest.append(hashlib.sha256(left).hexdigest())
                if with_bytes:
                    end = np.flatnonzero(np.diff(np.r_[covered, False].astype(np.int8)) < 0) + 1
                    kept.append(left)
                    found.append([{"first": a, "stop": b} for a, b in zip(begin.tolist(), end.tolist())])
            arrays = [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                      pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                arrays += [pa.array(kept, pa.binary()), pa.array(found, pa.list_(
                    pa.struct([("first", pa.int64()), ("stop", pa.int64())])))]
                names += ["kept", "spans"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
        ", kept binary, spans array<struct<first: bigint, stop: bigint>>" if with_bytes else "")
    return keyed.join(ranges, ["id", "tag"], "left").select("__id", "text", "ranges").mapInArrow(cut, schema)
