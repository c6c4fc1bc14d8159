"""Bounded-space online best-fit packing (operator 9).

A document's ids (then an end id) are cut into pieces of the sequence length;
only the last piece of a document can be shorter. Full pieces are sequences of
their own. The others are dealt evenly over tasks, and each task packs its
stream with a fixed number of open sequences: a bitset with one bit per amount
of free space finds the tightest open sequence that takes the piece; where none
does and all are in use, the fullest is closed. The sequences that a task has
left open are themselves packed, by the same best-fit, in a round with fewer
tasks, until one task is left; so what is wasted does not grow with the number
of tasks.

Defined results: null text counts as empty (one piece holding the end id);
repeated rows and null ids are packed like any others; extra columns are
ignored; an empty table gives no rows; a long text gives as many pieces as it
needs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import default_path, vocabulary
from .common import bound_batches, materialize, text_or_empty
from .word_ids import BatchMerger, WordIds

LENGTH = 4096
END_ID = 1
#: Sequences a task keeps open.
OPEN = 256
#: Pieces (or open sequences) that one task packs.
PER_TASK = 32_768


_READERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's id reader for a vocabulary file."""
    if path not in _READERS:
        vocab = vocabulary(path)
        _READERS[path] = WordIds(vocab, BatchMerger(vocab).encode)
    return _READERS[path]


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH,
           end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) for every document."""
    path = path or default_path()
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = word_ids(path)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            row, nth, start, size, crc, kept = [], [], [], [], [], []
            for r, ids in enumerate(reader.column(batch.column(1))):
                ids = np.concatenate([ids, end]).astype("<u4")
                for k, s in enumerate(range(0, len(ids), length)):
                    part = ids[s:s + length]
                    row.append(r)
                    nth.append(k)
                    start.append(s)
                    size.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(nth, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                       pa.array(crc, pa.int64())]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], text_or_empty(docs[text_col]).alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
             + (", ids array<int>" if with_ids else ""))


class BestFit:
    """A fixed number of open bins, found by free space through a bitset."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.free = 0                                   # bit f: an open bin has f free
        self.bins: dict[int, list[int]] = {}            # free space -> bins
        self.held: dict[int, list] = {}                 # bin -> (item, offset)
        self.made = 0

    def _take(self, space: int) -> int:
        stack = self.bins[space]
        b = stack.pop()
        if not stack:
            del self.bins[space]
            self.free &= ~(1 << space)
        return b

    def _keep(self, b: int, space: int) -> None:
        self.bins.setdefault(space, []).append(b)
        self.free |= 1 << space

    def add(self, item, size: int) -> Iterator[tuple[int, list]]:
        """Place an item; yields the bins that close."""
        fitting = self.free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            b = self._take(space)
        else:
            if len(self.held) >= self.limit:            # the fullest closes first
                full = self._take((self.free & -self.free).bit_length() - 1)
                yield full, self.held.pop(full)
            b, space = self.made, self.capacity
            self.made += 1
            self.held[b] = []
        self.held[b].append((item, self.capacity - space))
        if space == size:
            yield b, self.held.pop(b)
        else:
            self._keep(b, space - size)

    def fills(self) -> dict[int, int]:
        """Open bins and how full they are."""
        return {b: self.capacity - space for space, stack in self.bins.items() for b in stack}


def best_fit(items: DataFrame, size_col: str, tasks: int, capacity: int = LENGTH,
             limit: int = OPEN) -> DataFrame:
    """Every row with bin, offset, and ``fill`` (of a bin left open; else null)."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        packer = BestFit(capacity, limit)

        def rows(bins, fills):
            flat = [(*item, base + b, offset, fills.get(b)) for b, held in bins for item, offset in held]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*flat), out)], schema=pa.schema(out))

        out: list[pa.Field] = []
        closed: list = []
        for batch in batches:
            out = [*batch.schema, pa.field("bin", pa.int64()), pa.field("offset", pa.int64()),
                   pa.field("fill", pa.int64())]
            sizes = batch.column(batch.schema.get_field_index(size_col)).to_pylist()
            for item, size in zip(zip(*(c.to_pylist() for c in batch.columns)), sizes):
                closed.extend(packer.add(item, size))
            if closed:
                yield rows(closed, {})
                closed = []
        if packer.held:
            yield rows(list(packer.held.items()), packer.fills())

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return items.repartition(tasks).mapInArrow(run, f"{schema}, bin long, offset long, fill long")


def pack(cut: DataFrame, length: int = LENGTH, limit: int = OPEN,
         per_task: int = PER_TASK) -> DataFrame:
    """Rows of ``pieces`` with sequence_id and offset."""
    cut = materialize(cut, "pieces")
    rest = cut.filter(F.col("length") < length)
    n = rest.count()
    packed = materialize(best_fit(rest, "length", max(1, -(-n // per_task)), length, limit), "packed")
    done = [_columns(packed.filter("fill is null"), cut, 0)]
    left = packed.filter("fill is not null")
    tasks, level = -(-n // per_task), 0
    while tasks > 1:
        # Sequences left open by the tasks of this round become the items of
        # the next; a row follows its sequence, shifted by the new offset.
        level += 1
        open_bins = left.groupBy("bin").agg(F.max("fill").alias("size"))
        tasks = -(-(tasks * limit) // per_task)
        moved = materialize(best_fit(
            open_bins.withColumnRenamed("bin", "old"), "size", tasks, length, limit), "repacked")
        left = materialize(left.drop("fill").join(
            moved.select("old", F.col("bin").alias("new"), F.col("offset").alias("shift"), "fill"),
            F.col("bin") == F.col("old")).select(
                *[F.col(c) for c in cut.columns], F.col("new").alias("bin"),
                (F.col("offset") + F.col("shift")).alias("offset"), "fill"), "moved")
        done.append(_columns(left.filter("fill is null"), cut, level))
        left = left.filter("fill is not null")
    done.append(_columns(left, cut, level + 1))
    whole = cut.filter(F.col("length") == length).withColumns(
        {"sequence_id": F.monotonically_increasing_id() * 64 + 63, "offset": F.lit(0).cast("long")})
    for part in done:
        whole = whole.unionByName(part)
    return whole


def _columns(rows: DataFrame, cut: DataFrame, level: int) -> DataFrame:
    """Sequence numbers are apart by level (below 63) and task."""
    return rows.select(*cut.columns, (F.col("bin") * 64 + level).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH,
                   end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """Cut and pack ``docs``; see ``pieces`` and ``pack`` for the columns."""
    return pack(pieces(docs, path, length, end_id, id_col, text_col, with_ids), length)
