"""Words of letters, digits and everything beyond ASCII, found in one array
pass over the bytes of an Arrow text column (shared by operators 12 and 13).

A word is a maximal run of ``0-9``, ``A-Z``, ``a-z`` and all characters from
U+0080 on; only ``A-Z`` are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .word_ids import column_bytes, mix, row_groups, slices

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_STEP = 0x9E3779B97F4A7C15


@dataclass
class Words:
    """The words of some rows. ``text`` holds them lower-cased, each followed by
    one space; word i is ``text[begin[i]:end[i]]`` and stands at the bytes
    ``start[i]`` to ``stop[i]`` of its row; row r has the words ``first[r]`` to
    ``first[r + 1]``."""

    rows: tuple[int, int]
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def word_groups(column: pa.Array) -> Iterator[Words]:
    """The words of a string column (null: none), in groups of whole rows."""
    data, offsets = column_bytes(column)
    for a, b in row_groups(offsets):
        base = offsets[a]
        part, edge = data[base:offsets[b]], offsets[a:b + 1] - base
        inside = WORD[part]
        new = np.empty(len(part) + 1, bool)         # no word crosses a row
        new[0], new[1:] = True, ~inside
        new[edge] = True
        starts = np.flatnonzero(inside & new[:-1])
        new[:-1], new[-1] = ~inside, True
        new[edge] = True
        stops = np.flatnonzero(inside & new[1:]) + 1
        length = stops - starts
        end = np.cumsum(length + 1) - 1
        text = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
        text[slices(end - length, length)] = _LOWER[part[slices(starts, length)]]
        first = np.searchsorted(starts, edge)
        own = edge[np.repeat(np.arange(b - a), np.diff(first))]
        yield Words((a, b), text, end - length, end, starts - own, stops - own, first)


class WordHash:
    """64-bit hashes of words and of runs of words."""

    def __init__(self, seed: int = 12):
        rng = np.random.default_rng(seed)
        self.value = rng.integers(1, 1 << 63, 256, np.uint64)
        self.base = int(rng.integers(1, 1 << 62)) * 2 + 1
        self.power = np.ones(1, np.uint64)

    def words(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(begin):
            return np.zeros(0, np.uint64)
        length = end - begin
        longest = int(length.max()) + 1
        if len(self.power) < longest:
            self.power = np.full(longest, self.base, np.uint64)
            self.power[0] = 1
            self.power = np.cumprod(self.power, dtype=np.uint64)
        within = np.arange(len(text)) - np.repeat(begin, length + 1)
        value = self.value[text] * self.power[within]
        value[end] = 0                                  # the space after a word
        return mix(np.add.reduceat(value, begin) + length.astype(np.uint64))

    @staticmethod
    def runs(words: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on (as far as they go)."""
        n = len(words) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out, step = np.zeros(n, np.uint64), 1
        for i in range(length):
            out += words[i:i + n] * np.uint64(step)
            step = step * _STEP % (1 << 64)
        return mix(out + np.uint64(length))


class Sieve:
    """Which of many 64-bit hashes may be among a few: one bit table of at least
    16 places a hash leaves the rest to a search."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.shift = np.uint64(64 - max(12, int(len(self.sorted) * 16).bit_length()))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[self.sorted >> self.shift] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the hashes that are there, their rank among the few)."""
        if not len(self.sorted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.bits[hashes >> self.shift])
        rank = np.minimum(np.searchsorted(self.sorted, hashes[maybe]), len(self.sorted) - 1)
        hit = self.sorted[rank] == hashes[maybe]
        return maybe[hit], rank[hit]
