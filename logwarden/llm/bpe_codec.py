"""BPE encoding and decoding by tree concatenation (operator 4).

A piece longer than LEAF symbols is halved until its parts are short. The
leaves of all long pieces of a batch are encoded together, each on its own;
then neighbours are joined level by level. At a join a window of tokens on both
sides of the seam is merged anew. If the window's outermost tokens come out as
they were (or the window has reached the end of its side), both sides agree and
the rest stands; else the window grows: to the left it doubles, to the right it
takes in the next tokens, leaving behind what its left edge has settled. This is
exact, because a token sequence is what merging yields exactly if each
neighbouring pair is (so any run of a side's tokens is what its text yields).
Where both sides never agree, as in a long run of one letter, a join costs one
pass over its right side in small windows; equal windows are merged once.

Defined results: null text counts as empty and has no ids (digest of the empty
string); empty text likewise; repeated rows and null ids each give their own
row; extra columns are ignored; an empty table gives no rows; special strings
become their own ids, as in the library.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import Vocabulary, default_path, vocabulary
from .common import bound_batches, text_or_empty
from .word_ids import WordIds, slices

#: Symbols of a leaf of the tree.
LEAF = 48
#: Tokens that a window takes in on the right at a time, at most.
STEP = 32
#: Windows whose tokens a worker remembers.
REMEMBERED = 20_000
#: Ids that are printed at a time.
STRETCH = 1 << 16


class TreeEncoder:
    """Unsplittable pieces to tokens."""

    def __init__(self, vocab: Vocabulary, leaf: int = LEAF):
        self.v, self.leaf = vocab, leaf
        self._known: dict[tuple[str, ...], list[str]] = {}

    def _merged(self, parts: tuple[str, ...]) -> list[str]:
        """Tokens of the text of ``parts``."""
        found = self._known.get(parts)
        if found is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            v = self.v
            found = self._known[parts] = v.merge(
                [s for t in parts for s in v.symbols(t.removesuffix(v.end), t.endswith(v.end))])
        return found

    def join(self, left: list[str], right: list[str]) -> list[str]:
        """Tokens of two halves of one piece as tokens of the whole."""
        out, taken, step = list(left), 0, 1
        while taken < len(right):
            fresh = right[taken:taken + step]
            a = 1
            while True:
                a = min(a, len(out))
                middle = self._merged((*out[len(out) - a:], *fresh))
                if a == len(out) or middle[0] == out[-a]:
                    break
                a *= 2
            out[len(out) - a:] = middle
            taken += len(fresh)
            if middle[-1] == fresh[-1]:
                out += right[taken:]
                break
            step = min(2 * step, STEP)
        return out

    def encode_pieces(self, pieces: list[str]) -> list[list[str]]:
        """Tokens of each piece; long ones through the tree."""
        v = self.v
        levels: list[list[list[str]]] = []      # per piece: its current nodes
        for p in pieces:
            if len(p) <= self.leaf:
                levels.append([v.merge(v.symbols(p))])
            else:
                parts = 1 << (-(-len(p) // self.leaf) - 1).bit_length()
                cuts = [len(p) * i // parts for i in range(parts + 1)]
                levels.append([self._merged(tuple(v.symbols(p[x:y], final=y == len(p))))
                               for x, y in zip(cuts, cuts[1:])])
        while any(len(nodes) > 1 for nodes in levels):
            levels = [nodes if len(nodes) == 1 else
                      [self.join(nodes[i], nodes[i + 1]) for i in range(0, len(nodes), 2)]
                      for nodes in levels]
        return [nodes[0] for nodes in levels]

    def piece_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        tokens = self.encode_pieces(pieces)
        ids = self.v.ids
        return (np.array([ids[t] for ts in tokens for t in ts], np.int64),
                np.fromiter(map(len, tokens), np.int64, len(tokens)))


def decode_ids(vocab: Vocabulary, ids: list[int]) -> str:
    """Text of ids as the library's default decoding gives it for a file that
    names no decoder: the tokens, joined by single spaces."""
    return " ".join(map(vocab.names.__getitem__, ids))


class Printed:
    """What each id prints as, followed by a space, as slices of one array."""

    def __init__(self, strings: dict[int, str]):
        raw = {i: f"{s} ".encode() for i, s in strings.items()}
        n = max(raw) + 1
        self.length = np.array([len(raw.get(i, b"")) for i in range(n)], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(raw.get(i, b"") for i in range(n)), np.uint8)

    def sha256(self, ids: np.ndarray) -> str:
        digest = hashlib.sha256()
        for at in range(0, len(ids), STRETCH):
            part = ids[at:at + STRETCH]
            out = self.bytes[slices(self.start[part], self.length[part])]
            digest.update(out if at + STRETCH < len(ids) else out[:-1])   # no last space
        return digest.hexdigest()


class Codec:
    """A worker's encoder and decoder for a vocabulary file."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.reader = WordIds(self.v, TreeEncoder(self.v).piece_ids)
        self.numbers = Printed({i: str(i) for i in self.v.names})
        self.tokens = Printed(self.v.names)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _type(df: DataFrame, col: str) -> str:
    return f"`{col}` {df.schema[col].dataType.simpleString()}"


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row."""
    path = path or default_path()
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = codec(path).reader
        for batch in batches:
            ids = [i.astype(np.int32) for i in reader.column(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    return docs.select(docs[id_col], text_or_empty(docs[text_col]).alias("text")).mapInArrow(
        run, f"{_type(docs, id_col)}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id, text) from the rows of ``encode``."""
    path = path or default_path()
    bound_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = [decode_ids(vocab, ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(run, f"{_type(encoded, id_col)}, text string")


def codec_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding of
    every text in one pass, with only the digests leaving the worker."""
    path = path or default_path()
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for ids in c.reader.column(batch.column(1)):
                n.append(len(ids))
                ids_sha.append(c.numbers.sha256(ids))
                text_sha.append(c.tokens.sha256(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs[id_col], text_or_empty(docs[text_col]).alias("text")).mapInArrow(
        run, f"{_type(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
