"""Token ids of whole Arrow text columns through a table of known words.

Words (runs without ASCII white space) are found and hashed in one array pass
over a column's bytes; a 64-bit hash leads to a slice of one id pool. Only words
that this worker has not met yet are spelled out and encoded.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from .bpe import Vocabulary

#: Words after which a worker's table starts anew.
MAX_WORDS = 1_000_000
#: Texts are taken in groups of about this many bytes.
GROUP = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15 | 3
_MASK = (1 << 64) - 1


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column (null: empty)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return data[first:int(offsets[-1]) if len(offsets) else 0], offsets - first


def row_groups(offsets: np.ndarray, size: int = GROUP) -> list[tuple[int, int]]:
    """Row ranges of about ``size`` bytes (one row at least)."""
    out, first, n = [], 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(last, first + 1))
        out.append((first, last))
        first = last
    return out


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; no word crosses a row."""
    blank = SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = True, blank
    edge = offsets[(offsets >= 0) & (offsets <= len(data))]
    before[edge] = True                         # a row's first byte follows a break
    starts = np.flatnonzero(~blank & before[:-1])
    after = np.empty(len(data) + 1, bool)
    after[:-1], after[-1] = blank, True
    after[edge] = True
    ends = np.flatnonzero(~blank & after[1:]) + 1
    return starts, ends


class Hasher:
    """64-bit hashes of byte ranges from prefix sums of a random polynomial."""

    def __init__(self, seed: int = 42):
        self.value = np.random.default_rng(seed).integers(1, 1 << 63, 256, np.uint64)
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            size = max(n, GROUP)
            for name, base in (("power", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out, steps = np.zeros(len(data) + 1, np.uint64), self.value[data]
        steps *= self.power[:len(data)]
        np.cumsum(steps, out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class HashTable:
    """Open-addressing table from 64-bit keys to row numbers."""

    def __init__(self, bits: int = 18):
        self.bits = bits
        self.keys = np.zeros(1 << bits, np.uint64)
        self.rows = np.zeros(1 << bits, np.int32)
        self.count = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is not known."""
        slot = self._slot(keys)
        there = self.keys[slot]
        rows = np.where(there == keys, self.rows[slot], -1)
        todo = np.flatnonzero((there != keys) & (there != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[todo]]
            hit = there == keys[todo]
            rows[todo[hit]] = self.rows[slot[todo[hit]]]
            todo = todo[~hit & (there != 0)]
        return rows

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Distinct keys that are not in the table yet."""
        if (self.count + len(keys)) * 2 > len(self.keys):
            old = np.flatnonzero(self.keys)
            held, at = self.keys[old], self.rows[old]
            while (self.count + len(keys)) * 2 > (1 << self.bits):
                self.bits += 1
            self.keys = np.zeros(1 << self.bits, np.uint64)
            self.rows = np.zeros(1 << self.bits, np.int32)
            self._put(held, at)
        self._put(keys, rows)
        self.count += len(keys)

    def _put(self, keys: np.ndarray, rows: np.ndarray) -> None:
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            self.keys[slot[free]] = keys[free]
            self.rows[slot[free]] = rows[free]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)


class Rows:
    """A growing array."""

    def __init__(self, dtype):
        self.data, self.n = np.zeros(1 << 16, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        while self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.n:self.n + len(values)] = values
        self.n += len(values)


def slices(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start[0], start[0]+1, .. of all slices, one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


class BatchMerger:
    """Byte-pair merging of many short pieces at once: one array row each; every
    round merges each row's lowest-ranked (leftmost) pair."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        pairs = list(vocab.ranks)
        a = np.array([vocab.ids[x] for x, _ in pairs], np.uint64)
        b = np.array([vocab.ids[y] for _, y in pairs], np.uint64)
        self.merged = np.array([vocab.ids[x + y] for x, y in pairs] + [0], np.int64)
        self.none = len(pairs)
        self.table = HashTable()
        self.table.add(self._key(a, b), np.arange(len(pairs), dtype=np.int32))
        self.first, self.last = np.full(512, -1, np.int64), np.full(512, -1, np.int64)
        for c in vocab.byte_char:
            self.first[ord(c)], self.last[ord(c)] = vocab.ids[c], vocab.ids[c + vocab.end]

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.uint64) << np.uint64(32)) + b.astype(np.uint64) + np.uint64(1)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rank = self.table.find(self._key(a, b))
        rank[(rank < 0) | (a < 0) | (b < 0)] = self.none
        return rank

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        chars = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        first, last = self.first[chars], np.cumsum(size) - 1
        symbols = first
        symbols[last] = self.last[chars[last]]
        start = last + 1 - size
        order = np.argsort(size, kind="stable")
        found: list[np.ndarray] = []            # per stretch of rows: their ids
        length = np.zeros(len(pieces), np.int64)
        at = 0
        while at < len(order):
            width = int(size[order[at]])
            end = min(at + 20_000, int(np.searchsorted(size[order], max(8, width + width // 2), side="right")))
            rows = order[at:end]
            if width > 64:
                ids = [[self.v.ids[t] for t in self.v.merge(self.v.symbols(pieces[i]))] for i in rows]
                length[rows] = [len(x) for x in ids]
                found.append(np.array([i for x in ids for i in x], np.int64))
            else:
                grid = self._merge(symbols, start[rows], size[rows])
                kept = grid >= 0
                length[rows] = kept.sum(axis=1)
                found.append(grid[kept])
            at = end
        # from the order by size back to the order given
        begin = np.empty(len(pieces), np.int64)
        begin[order] = np.cumsum(length[order]) - length[order]
        return np.concatenate(found)[slices(begin, length)] if found else np.zeros(0, np.int64), length

    def _merge(self, symbols: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        n, width = len(size), int(size.max())
        grid = np.full((n, width + 1), -1, np.int64)
        column = np.arange(width + 1)
        grid[column < size[:, None]] = symbols[slices(start, size)]
        rank = np.full((n, width + 1), self.none, np.int32)
        rank[:, :-1] = self._ranks(grid[:, :-1].ravel(), grid[:, 1:].ravel()).reshape(n, width)
        live = np.arange(n)
        while len(live):
            at = rank[live].argmin(axis=1)
            best = rank[live, at]
            go = best < self.none
            live, at, best = live[go], at[go], best[go]
            if not len(live):
                break
            shift = np.minimum(column + (column > at[:, None]), width)
            g = np.take_along_axis(grid[live], shift, 1)
            r = np.take_along_axis(rank[live], shift, 1)
            k = np.arange(len(live))
            g[k, at] = self.merged[best]
            g[:, -1], r[:, -1] = -1, self.none
            r[k, at] = self._ranks(g[k, at], g[k, np.minimum(at + 1, width)])
            left = np.maximum(at - 1, 0)
            again = self._ranks(g[k, left], g[k, at])
            r[k, left] = np.where(at > 0, again, r[k, left])
            grid[live], rank[live] = g, r
        return grid


class WordIds:
    """Ids of whole texts; ``encode_pieces`` gives the ids of all pieces, one
    after the other, and how many each has."""

    def __init__(self, vocab: Vocabulary,
                 encode_pieces: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.v, self.encode_pieces = vocab, encode_pieces
        self.hasher = Hasher()
        self._reset()

    def _reset(self) -> None:
        self.table = HashTable()
        self.pool, self.start, self.length = Rows(np.uint16 if max(self.v.names) < 65536 else np.uint32), \
            Rows(np.int32), Rows(np.int32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        split = [self.v.pieces(w) for w in words]
        distinct = list(dict.fromkeys(p for ps in split for p in ps))
        ids, size = self.encode_pieces(distinct)
        number = dict(zip(distinct, range(len(distinct))))
        used = np.array([number[p] for ps in split for p in ps], np.int64)
        parts = np.fromiter(map(len, split), np.int64, len(split))
        total = np.concatenate([[0], np.cumsum(size[used])])
        ends = np.cumsum(parts)
        length = total[ends] - total[ends - parts]
        flat = ids[slices((np.cumsum(size) - size)[used], size[used])]
        first = self.start.n
        self.start.extend(self.pool.n + np.cumsum(length) - length)
        self.length.extend(length)
        self.pool.extend(flat)
        self.table.add(keys, np.arange(first, self.start.n, dtype=np.int32))

    def group(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows of one group and the rows' offsets into them."""
        if self.table.count > MAX_WORDS:
            self._reset()
        starts, ends = word_bounds(data, offsets)
        keys = self.hasher.ranges(self.hasher.sums(data), starts, ends)
        keys[keys == 0] = 1
        rows = self.table.find(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            distinct, at = np.unique(keys[new], return_index=True)
            at = new[at]
            raw = data.tobytes()
            self._learn(distinct, [raw[s:e].decode() for s, e in
                                   zip(starts[at].tolist(), ends[at].tolist())])
            rows[new] = self.table.find(keys[new])
        length = self.length.data[rows]
        ids = self.pool.data[slices(self.start.data[rows].astype(np.int64), length.astype(np.int64))]
        total = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(length, out=total[1:])
        return ids, total[np.searchsorted(starts, offsets)]

    def column(self, column: pa.Array):
        """(ids of a row) for every row of a string column, in order."""
        data, offsets = column_bytes(column)
        marked = {}
        if self.v.special:
            for s in self.v.special:
                for r in np.flatnonzero(np.asarray(
                        pa.compute.match_substring(column.fill_null(""), s))).tolist():
                    marked[r] = column[r].as_py()
        for first, last in row_groups(offsets):
            base = offsets[first]
            ids, at = self.group(data[base:offsets[last]], offsets[first:last + 1] - base)
            for r in range(first, last):
                yield self._marked(marked[r]) if r in marked else ids[at[r - first]:at[r - first + 1]]

    def _marked(self, text: str) -> np.ndarray:
        """Ids of a text that holds special strings."""
        parts = []
        for part in self.v._split_special.split(text):
            if part in self.v.special:
                parts.append(np.array([self.v.special[part]], self.pool.data.dtype))
            else:
                raw = np.frombuffer(part.encode(), np.uint8)
                parts.append(self.group(raw, np.array([0, len(raw)]))[0])
        return np.concatenate(parts)
