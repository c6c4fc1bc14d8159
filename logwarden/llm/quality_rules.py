"""Weak supervision by quality rules (operator 6).

Each rule looks at a few figures of a text and votes keep, reject or abstain.
Expectation-maximisation over the counts of the vote patterns estimates how
often each rule votes right on good and on bad texts (no labels are used), and
a text's posterior probability of being good replaces the usual all-must-pass
filter. Patterns are counted over all texts; their number is bounded by three
to the number of rules, whatever the size of the corpus.

Defined results: null text counts as empty (no words: every figure 0, base
failed); repeated rows and null ids each get their own row; extra columns are
ignored by ``judge`` and kept by ``keep_documents``; an empty table gives no
rows; a text's figures cover all of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, materialize, text_or_empty
from .word_ids import SPACE, Hasher, column_bytes, mix, row_groups, word_bounds

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Common short words of the corpus languages.
FUNCTION_WORDS = ("the and of to in is that it for with as was on by this "
                  "der die das und ist in den von zu mit auf für im ein "
                  "le la les de des et un une du en que qui dans pour "
                  "el los las y del se por con una").split()

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
           "n_exclaim", "n_upper", "n_letters", "n_echo", "n_function", "n_closed")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a"):ord("z") + 1] = True
_CLOSING = np.zeros(256, bool)
_CLOSING[[ord(c) for c in ".,;:?!"]] = True
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


class Figures:
    """Figures of all texts of a string column, in array passes."""

    def __init__(self):
        self.hasher = Hasher()
        raw = " ".join(FUNCTION_WORDS).encode()
        data = np.frombuffer(raw, np.uint8)
        s, e = word_bounds(data, np.array([0, len(data)]))
        self.function = np.unique(self.hasher.ranges(self.hasher.sums(data), s, e))

    def column(self, column: pa.Array) -> dict[str, np.ndarray]:
        data, offsets = column_bytes(column)
        found = [self.group(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                 for a, b in row_groups(offsets)]
        return {k: np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64)
                for k in FIGURES}

    def group(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        starts, ends = word_bounds(data, offsets)
        first = np.searchsorted(starts, offsets)               # first word of each row
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))

        def of_bytes(flag: np.ndarray) -> np.ndarray:
            total = np.zeros(len(data) + 1, np.int64)
            np.cumsum(flag, out=total[1:])
            return total[offsets[1:]] - total[offsets[:-1]]

        def of_words(flag: np.ndarray) -> np.ndarray:
            total = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(flag, out=total[1:])
            return total[first[1:]] - total[first[:-1]]

        in_word = ~SPACE[data]
        words = self.hasher.ranges(self.hasher.sums(data), starts, ends)
        lower = data | (_UPPER[data].astype(np.uint8) << 5)
        plain = self.hasher.ranges(self.hasher.sums(lower), starts, ends)
        echo = np.zeros(len(starts), bool)
        echo[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
        lines = self._lines(data, offsets)
        return {
            "n_words": np.diff(first).astype(np.int64),
            "word_chars": of_bytes(in_word & ((data & 0xC0) != 0x80)),
            "n_symbols": of_bytes(_SYMBOL[data]),
            "n_dup_lines": lines[1],
            "n_repeat_words": of_words(self._repeated(words, row)),
            "n_lines": lines[0],
            "n_exclaim": of_bytes(data == ord("!")),
            "n_upper": of_bytes(_UPPER[data]),
            "n_letters": of_bytes(_LETTER[data]),
            "n_echo": of_words(echo),
            "n_function": of_words(np.isin(plain, self.function)),
            "n_closed": of_words(_CLOSING[data[ends - 1]] if len(ends) else np.zeros(0, bool)),
        }

    @staticmethod
    def _repeated(words: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Words in a window that its row holds twice or more."""
        n = len(words) - WINDOW + 1
        if n < 1:
            return np.zeros(len(words), bool)
        key = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            key = key * _STEP + words[k:k + n]
        inside = np.flatnonzero(row[:n] == row[WINDOW - 1:])
        key = mix(key[inside] + row[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        edge = np.zeros(len(words) + 1, np.int64)      # windows begin and end
        edge[inside[twice]] += 1
        edge[inside[twice] + WINDOW] -= 1
        return np.cumsum(edge)[:-1] > 0

    @staticmethod
    def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those equal to an earlier one, per row."""
        raw = data.tobytes()
        n, dup = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            lines = [x for x in raw[a:b].split(b"\n") if x.strip(b" \t\n\v\f\r")]
            n.append(len(lines))
            dup.append(len(lines) - len(set(lines)))
        return np.array(n, np.int64), np.array(dup, np.int64)


def base_failed(prefix: str = "") -> Column:
    """Too few words, or too many of them in repeated windows."""
    n, repeat = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < MIN_WORDS) | (repeat * 100 > n * MAX_REPEAT_PERCENT)


def _vote(reject: Column, keep: Column) -> Column:
    """-1 reject, 1 keep, 0 abstain."""
    return F.when(reject, -1).when(keep, 1).otherwise(0)


def rules(prefix: str = "") -> dict[str, Column]:
    """Each rule's vote from the figures (columns named with ``prefix``)."""
    def share(part: str, whole: str = "n_words") -> Column:
        return F.col(prefix + part) / F.greatest(F.col(prefix + whole), F.lit(1))

    symbols, exclaim, echo = share("n_symbols"), share("n_exclaim"), share("n_echo")
    upper, repeat, function = share("n_upper", "n_letters"), share("n_repeat_words"), share("n_function")
    closed, length = share("n_closed"), share("word_chars")
    return {
        "symbols": _vote(symbols > 0.1, symbols < 0.02),
        "exclaim": _vote(exclaim > 0.1, exclaim < 0.02),
        "upper": _vote(upper > 0.4, upper < 0.15),
        "echo": _vote(echo > 0.1, echo < 0.03),
        "repeat": _vote(repeat > 0.2, repeat == 0),
        "function": _vote(function < 0.02, function > 0.08),
        "closed": _vote(closed > 0.6, (closed > 0.01) & (closed < 0.3)),
        "word_length": _vote((length < 2) | (length > 15), (length > 3) & (length < 10)),
    }


#: EM: rounds at most, change at which it ends, and prior counts of votes.
ROUNDS, CHANGE, PRIOR_VOTES = 200, 1e-9, 4.0
PRIOR_GOOD, PRIOR_REJECT_GOOD, PRIOR_REJECT_BAD = 0.85, 0.02, 0.4


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """EM over vote patterns (rows of -1, 0, 1): the share of good texts, and
    P(reject | good or bad, not abstained) per rule as two rows. Votes are
    independent given the class; abstentions carry no information."""
    good, reject = PRIOR_GOOD, np.array([[PRIOR_REJECT_GOOD] * patterns.shape[1],
                                         [PRIOR_REJECT_BAD] * patterns.shape[1]])
    prior = reject * PRIOR_VOTES
    no, yes = (patterns < 0).astype(float), (patterns > 0).astype(float)
    for _ in range(ROUNDS):
        odds = math.log(good / (1 - good)) + no @ np.log(reject[0] / reject[1]) + \
            yes @ np.log((1 - reject[0]) / (1 - reject[1]))
        post = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        weight = np.stack([post * counts, (1 - post) * counts])
        new = (weight @ no + prior) / (weight @ (no + yes) + PRIOR_VOTES)
        share = (weight[0].sum() + PRIOR_GOOD * PRIOR_VOTES) / (counts.sum() + PRIOR_VOTES)
        moved = max(abs(new - reject).max(), abs(share - good))
        good, reject = float(share), new
        if moved < CHANGE:
            break
    return good, reject


def posterior(good: float, reject: np.ndarray, votes: list[Column]) -> Column:
    """Probability of a good text from its votes."""
    odds = F.lit(math.log(good / (1 - good)))
    for j, vote in enumerate(votes):
        odds = odds + F.when(vote < 0, float(math.log(reject[0, j] / reject[1, j]))).when(
            vote > 0, float(math.log((1 - reject[0, j]) / (1 - reject[1, j])))).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the FIGURES) of every text."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Figures()
        for batch in batches:
            found = f.column(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(found[k], pa.int64()) for k in FIGURES)],
                names=[id_col, *FIGURES])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], text_or_empty(docs[text_col]).alias("text")).mapInArrow(
        run, ", ".join([f"`{id_col}` {kind}", *(f"{k} long" for k in FIGURES)]))


def learn(stats: DataFrame) -> tuple[float, np.ndarray]:
    """EM over the vote patterns of all texts (at most three to the number of
    rules come to the driver)."""
    votes = rules()
    rows = stats.groupBy(*[v.alias(k) for k, v in votes.items()]).count().collect()
    if not rows:
        return PRIOR_GOOD, np.array([[PRIOR_REJECT_GOOD] * len(votes), [PRIOR_REJECT_BAD] * len(votes)])
    rows = sorted(tuple(r) for r in rows)
    return estimate(np.array([r[:-1] for r in rows]), np.array([r[-1] for r in rows], float))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, quality_probability, kept) of every text."""
    stats = materialize(figures(docs, id_col, text_col), "figures")
    good, reject = learn(stats)
    return stats.select(
        F.col(id_col), *FIGURES[:5], base_failed().alias("base_failed"),
        posterior(good, reject, list(rules().values())).alias("quality_probability")).withColumn(
            "kept", ~F.col("base_failed") & (F.col("quality_probability") >= 0.5))


def keep_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns. Figures
    are made twice (to learn, then to judge), so texts are never shuffled."""
    prefix = "__"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    row = f"{prefix}row"
    good, reject = learn(figures(docs.select(F.lit(0).alias(row), text_col), row, text_col))
    names = docs.columns + [prefix + k for k in FIGURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Figures()
        for batch in batches:
            found = f.column(batch.column(batch.schema.get_field_index(text_col)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(found[k], pa.int64()) for k in FIGURES)], names=names)

    bound_batches(docs.sparkSession)
    schema = ", ".join([f"`{c.name}` {c.dataType.simpleString()}" for c in docs.schema]
                       + [f"`{prefix}{k}` long" for k in FIGURES])
    judged = docs.mapInArrow(run, schema)
    return judged.filter(~base_failed(prefix) & (posterior(
        good, reject, list(rules(prefix).values())) >= 0.5)).select(
            *[F.col(f"`{c}`") for c in docs.columns])
