"""Token counts by a finite-state tokeniser (operator 1).

The tokeniser is compiled, on demand, into one deterministic transducer over
characters. A state holds all that later characters can depend on: the kind of
the open piece, the longest suffix that some vocabulary token still continues,
and for each position such a token could start at, the token that ends there
and its count relative to the present one. (A token sequence is what byte-pair
merging yields exactly if each neighbouring pair is; so the last token of every
prefix is unique and a bounded window decides the next.) Each transition is
annotated with the number of tokens it emits; white space emits what closes
the piece and leads back to the start state.

Texts are cut into chunks of equal length that run in lockstep as lanes of one
array program. A chunk's state map is a table entry -> (exit, tokens), filled
for the entry that its left context suggests; neighbouring maps compose by a
parallel prefix scan, and a chunk whose entry turns out to be another state
adds that row and the scan runs again, so counts are exact.

Defined results: null text counts as empty (0 bytes, 0 tokens); null ids and
repeated rows each give their own row; extra columns are ignored; an empty
table gives no rows; texts of any length are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import Vocabulary, default_path, vocabulary
from .common import bound_batches, text_or_empty

#: Characters in one chunk (lane).
CHUNK = 2048
#: Left context that suggests a chunk's entry state.
CONTEXT = 64
#: Symbols with a table column of their own; rarer ones are kept in a dictionary.
DENSE = 112
#: States after which a worker compiles afresh, within a batch too: what runs is
#: taken again in halves, down to one chunk, and a text's state is carried on.
MAX_STATES = 250_000
OVER = 2048

START = 0
SPACE = 0  # symbol


class Full(Exception):
    """The transducer has reached MAX_STATES."""


class Transducer:
    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        # Proper beginnings of tokens: what an unfinished token may look like.
        self.beginnings: set[str] = set()
        for token in vocab.ids:
            body = token.removesuffix(vocab.end)
            for n in range(1, len(body)):
                self.beginnings.add(body[:n])
        self.symbol_of = np.full(0x110000, -1, np.int32)
        self.symbols: list[tuple[str, str, str]] = [(" ", "s", "")]   # char, class, spelling
        self.symbol_of[32] = SPACE
        self._numbers: dict[str, int] = {}
        self.bounded = True
        self._reset()

    def _reset(self) -> None:
        self._pairs: dict[tuple[str | None, str], bool] = {}
        self._entries: dict[tuple, tuple] = {}
        self.ids: dict[tuple, int] = {("start",): START}
        self.states: list[tuple] = [("start",)]
        self.next = np.full((1024, DENSE), -1, np.int32)
        self.emit = np.zeros((1024, DENSE), np.int8)
        self.rare: dict[tuple[int, int], tuple[int, int]] = {}

    # -- compilation ---------------------------------------------------------

    def _fits(self, before: str | None, token: str) -> bool:
        """Whether merging leaves ``token`` whole after ``before``."""
        key = (before, token)
        known = self._pairs.get(key)
        if known is None:
            v = self.v
            parts = [] if before is None else list(before)
            final = token.endswith(v.end)
            parts += v.symbols(token.removesuffix(v.end), final)
            want = [token] if before is None else [before, token]
            known = v.merge(parts) == want
            self._pairs[key] = known
        return known

    def _grow(self, state: tuple, spelled: str) -> tuple[tuple, int]:
        """Word state (suffix, history, closing count) after more characters
        of the same piece, and the tokens emitted on the way."""
        total = 0
        for c in spelled:
            state, n = self._grow_one(state, c)
            total += n
        return state, total

    def _grow_one(self, state: tuple, c: str) -> tuple[tuple, int]:
        suffix, history, _ = state
        v = self.v
        end = None
        for length, last, ahead in history:      # longest suffix first
            stem = suffix[len(suffix) - length:] + c
            if end is None and stem in v.ids and self._fits(last, stem):
                end = (stem, ahead + 1)
                break
        if end is None:
            raise ValueError(f"no token ends after {suffix + c!r}")
        token, emitted = end
        closing = next(ahead + 1 - emitted for length, last, ahead in history
                       if (t := suffix[len(suffix) - length:] + c + v.end) in v.ids
                       and self._fits(last, t))
        later = []
        for length, last, ahead in history:
            if suffix[len(suffix) - length:] + c in self.beginnings:
                later.append((length + 1, last, ahead - emitted))
        grown = (suffix + c)[len(suffix) + 1 - later[0][0]:] if later else ""
        later.append((0, token, 0))
        return (grown, tuple(map(self._shared, later)), closing), emitted

    def _shared(self, entry: tuple) -> tuple:
        """One copy of equal history entries."""
        return self._entries.setdefault(entry, entry)

    _EMPTY = ("", ((0, None, 0),), 0)

    def _open(self, kind: str, spelled: str) -> tuple[tuple, int]:
        state, n = self._grow(self._EMPTY, spelled)
        return (kind, state), n

    def _whole(self, spelled: str) -> int:
        """Tokens of a closed piece."""
        n = self._numbers.get(spelled)
        if n is None:
            n = self._numbers[spelled] = len(self.v.merge(self.v.symbols(spelled)))
        return n

    def _begin(self, char: str, kind: str, spelled: str) -> tuple[tuple, int]:
        """From the start state over one character."""
        if kind == "s":
            return ("start",), 0
        if kind == "n":
            return ("start",), self._whole(spelled)
        if char == "'":
            return ("quote", ""), 0
        return self._open(kind, spelled)

    def _step(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        char, kind, spelled = self.symbols[symbol]
        tag = state[0]
        if tag == "start":
            return self._begin(char, kind, spelled)
        if tag == "quote":                       # an apostrophe that began a piece
            held = state[1]
            if not held and char in "stmd" and kind == "l":
                return ("start",), self._whole("'" + char)
            if not held and char in "rvl" and kind == "l":
                return ("quote", char), 0
            if held + char in ("re", "ve", "ll"):
                return ("start",), self._whole("'" + held + char)
            if not held and kind == "o":         # runs on as punctuation
                return self._open("o", "'" + spelled)
            state, n = ("start",), self._whole("'")
            if held:
                state, m = self._open("l", held)
                n += m
            state, m = self._step(state, symbol)
            return state, n + m
        if kind == tag:
            word, n = self._grow(state[1], spelled)
            return (tag, word), n
        following, n = self._begin(char, kind, spelled)
        return following, n + state[1][2]

    def _id(self, state: tuple) -> int:
        i = self.ids.get(state)
        if i is None:
            if self.bounded and len(self.states) >= MAX_STATES:
                raise Full
            i = self.ids[state] = len(self.states)
            self.states.append(state)
            if i >= len(self.next):
                more = min(i, 32_768)
                self.next = np.concatenate([self.next, np.full((more, DENSE), -1, np.int32)])
                self.emit = np.concatenate([self.emit, np.zeros((more, DENSE), np.int8)])
        return i

    def _transition(self, state: int, symbol: int) -> tuple[int, int]:
        if symbol >= DENSE and (known := self.rare.get((state, symbol))):
            return known
        following, n = self._step(self.states[state], symbol)
        result = (self._id(following), n)
        if symbol < DENSE:
            self.next[state, symbol], self.emit[state, symbol] = result
        else:
            self.rare[(state, symbol)] = result
        return result

    # -- texts ---------------------------------------------------------------

    def normal(self, text: str) -> tuple[str, int]:
        """Normalised text and the number of special strings in it."""
        v, n = self.v, 0
        if v.special and any(s in text for s in v.special):
            parts = v._split_special.split(text)
            n = sum(p in v.special for p in parts)
            return " ".join(v.normalize(p) for p in parts if p not in v.special), n
        if text.isascii():
            return text.lower(), n
        return v.normalize(text), n

    def encode_symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, each followed by a space, and text lengths."""
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        lengths = np.fromiter((len(p) + 1 for p in points), np.int64, len(points))
        space = np.array([32], np.uint32)
        flat = np.concatenate([x for p in points for x in (p, space)])
        codes = self.symbol_of[flat]
        if (codes < 0).any():
            for point in np.unique(flat[codes < 0]).tolist():
                char = chr(point)
                kind = self.v.char_class(char)
                if kind == "s":
                    self.symbol_of[point] = SPACE
                else:
                    self.symbol_of[point] = len(self.symbols)
                    self.symbols.append((char, kind, self.v.spell(char)))
            codes = self.symbol_of[flat]
        return codes, lengths

    def run(self, codes: np.ndarray, entry: np.ndarray, start: np.ndarray,
            length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run lanes over codes[start:start+length] in lockstep; exits, tokens."""
        order = np.argsort(-length, kind="stable")
        state, at, left = entry[order].astype(np.int64), start[order], length[order]
        tokens = np.zeros(len(order), np.int64)
        steps = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")
        for k, live in enumerate(steps.tolist()):
            seen = codes[at[:live] + k]
            cell = state[:live] * DENSE + seen
            odd = None
            if len(self.symbols) > DENSE and (wide := seen >= DENSE).any():
                odd = np.flatnonzero(wide)
                cell[odd] = 0
            to = self.next.ravel().take(cell)
            if odd is not None:
                to[odd] = 0
            if to.min() < 0:
                for i in np.flatnonzero(to < 0).tolist():
                    if self.next[state[i], seen[i]] < 0:
                        self._transition(int(state[i]), int(seen[i]))
                to = self.next.ravel().take(cell)
                if odd is not None:
                    to[odd] = 0
            count = self.emit.ravel().take(cell).astype(np.int64)
            if odd is not None:
                for i in odd.tolist():
                    to[i], count[i] = self._transition(int(state[i]), int(seen[i]))
            tokens[:live] += count
            state[:live] = to
        exits, counts = np.empty_like(state), np.empty_like(tokens)
        exits[order], counts[order] = state, tokens
        return exits, counts

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if not texts:
            return np.zeros(0, np.int64)
        plain, extra = zip(*map(self.normal, texts))
        codes, lengths = self.encode_symbols(list(plain))
        ends = np.cumsum(lengths)
        chunks = -(-lengths // CHUNK)
        doc = np.repeat(np.arange(len(texts)), chunks)
        first = np.cumsum(chunks) - chunks
        nth = np.arange(len(doc)) - first[doc]
        start = (ends - lengths)[doc] + nth * CHUNK
        size = np.minimum(CHUNK, ends[doc] - start)
        found = np.array(extra, np.int64)
        waves, state = [(0, len(doc))], ("start",)      # state: where the last wave ended
        while waves:
            lo, hi = waves.pop()
            fresh, self.bounded = len(self.states) == 1, hi - lo > 1
            try:
                entry = self._id(state) if nth[lo] else START
                exits, total = self._wave(codes, doc[lo:hi], nth[lo:hi], start[lo:hi], size[lo:hi], entry)
            except Full:
                self._reset()
                middle = (lo + hi) // 2
                waves += [(middle, hi), (lo, middle)] if fresh else [(lo, hi)]
                continue
            last = np.r_[doc[lo + 1:hi] != doc[lo:hi - 1], True]
            found[doc[lo:hi][last]] += total[last]
            state = self.states[exits[-1]]
            if len(self.states) >= MAX_STATES:
                self._reset()
        return found

    def _wave(self, codes: np.ndarray, doc: np.ndarray, nth: np.ndarray, start: np.ndarray,
              size: np.ndarray, entry_state: int) -> tuple[np.ndarray, np.ndarray]:
        """Exits of neighbouring chunks, and the tokens of each one's text up to
        its end, from the first chunk on (which is entered in ``entry_state``)."""
        # Entry of a chunk: what its left context leads to from the start state.
        entry = np.zeros(len(doc), np.int64)
        inner = np.flatnonzero(nth > 0)
        inner = inner[inner > 0]
        if len(inner):
            context = codes[start[inner][:, None] - np.arange(1, CONTEXT + 1)] == SPACE
            near = np.where(context.any(axis=1), context.argmax(axis=1), CONTEXT)
            entry[inner], _ = self.run(codes, np.zeros(len(inner), np.int64), start[inner] - near, near)
        entry[0] = entry_state
        exits, tokens = self.run(codes, entry, start, size)
        while True:
            joined, total = prefix_scan(doc, entry, exits, tokens)
            wrong = np.flatnonzero(~joined)
            if not len(wrong):
                return exits, total
            wrong = wrong[np.r_[True, doc[wrong[1:]] != doc[wrong[:-1]]]]   # first of each text
            entry[wrong] = exits[wrong - 1]
            exits[wrong], tokens[wrong] = self.run(codes, entry[wrong], start[wrong], size[wrong])


def prefix_scan(doc: np.ndarray, entry: np.ndarray, exits: np.ndarray,
                tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compose neighbouring state maps in doubling steps. Returns, per chunk,
    whether the map of all chunks up to it is defined (every exit is the next
    entry), and its token count. Composition (a, b) -> (entry of a, exit of b,
    sum) is associative, so each step joins spans of twice the length."""
    n = len(doc)
    span_entry, total = entry.copy(), tokens.copy()
    defined = np.ones(n, bool)
    reach = np.arange(n)                      # first chunk of the span that ends here
    first = np.r_[True, doc[1:] != doc[:-1]] if n else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else reach
    while True:
        todo = np.flatnonzero(reach > head)
        if not len(todo):
            return defined, total
        left = reach[todo] - 1
        ok = defined[left] & defined[todo] & (exits[left] == span_entry[todo])
        new_entry, new_total, new_reach = span_entry[left], total[left] + total[todo], reach[left]
        span_entry[todo], total[todo], reach[todo], defined[todo] = new_entry, new_total, new_reach, ok


_MACHINES: dict[str, Transducer] = {}


def machine(path: str) -> Transducer:
    """The worker's transducer for a vocabulary file."""
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(vocabulary(path))
    return _MACHINES[path]


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", over: int = OVER) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    path = path or default_path()
    bound_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = m.count(texts)
            size = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(n > over)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], text_or_empty(docs[text_col]).alias("text")).mapInArrow(
        count, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
