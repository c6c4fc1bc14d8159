"""Spelling variants by PartEnum signatures (operator 11).

Two words that differ by one inserted, deleted or replaced code point have
letter multisets whose binary vectors differ in at most two places. The letters
are dealt into PARTS parts; of two such words at most two parts differ, so they
agree on all parts but some two. Every word gets one signature for each choice
of two parts left out (partition and enumerate): the choice and the multisets of
the other parts. Words with a common signature meet in an equi-join, and the
pairs are verified by their edit distance. The search is exact.

A part's multiset is held as eight bits of a hash of its sorted letters, a
word's parts as one long; a signature is that long with the two parts blanked.
Equal multisets have equal bits, so no pair is lost; others that meet by chance
fail the verification. Of the signatures that a pair shares only the first
yields it. All of it runs in the JVM. A common signature is split over tasks by
Spark's skew join; inside a group the conditions are ordered from cheap to
costly, and only near pairs leave the join.

Defined results: null and empty texts have no words; a null id counts as the
empty text where words are damaged; texts are taken whole, repeated rows count
each; words of equal count rank by code-point order; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

#: Letters of a word: A-Z, a-z, U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Parts of the letters (one byte of a long each) and places left out.
PARTS = 8
APART = 2
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A word's form is this many times as frequent.
RATIO = 5
#: Every word whose checksum this divides loses a letter (the query's contract).
DAMAGE_STEP = 199
#: Longest chains of forms halve each round; counts grow RATIO-fold along them.
MAX_ROUNDS = 30


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
               damage_step: int | None = None) -> DataFrame:
    """(word, n) of all words of ``least_length`` code points and ``least_count``
    occurrences. With ``damage_step`` a run whose crc32 (of ``id:run``) it
    divides loses the code point at crc32 % length before it is counted."""
    lowered = F.translate(text_or_empty(docs[text_col]), _UPPER, _UPPER.lower())
    # Greedy, so a match is a maximal run; shorter runs cannot make a word.
    runs = docs.select(
        F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{least_length},}}"),
                                       F.lit(0))).alias("run"))
    word = F.col("run")
    if damage_step:
        h = F.crc32(F.concat("id", F.lit(":"), "run"))
        at = (h % F.char_length("run")).cast("int")
        word = F.when(h % damage_step == 0, F.concat(
            F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length("run")))).otherwise(word)
    words = runs.select(word.alias("word")).filter(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def letter_parts(words: DataFrame, parts: int = PARTS) -> list[str]:
    """The letters of each part: all letters by the number of words that hold
    them, dealt to and fro, so that no part gets several of the commonest. The
    driver sees one row a letter of the class, 90 at most."""
    seen = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).groupBy("c").count()
    ranked = [r["c"] for r in sorted(seen.collect(), key=lambda r: (-r["count"], r["c"])) if r["c"]]
    out = [""] * parts
    for i, c in enumerate(ranked):
        turn, at = divmod(i, parts)
        out[at if turn % 2 == 0 else parts - 1 - at] += c
    return out


def part_code(word: Column, parts: list[str]) -> Column:
    """Eight bits a part of the word's letter multiset, as one long."""
    every, code = "".join(parts), F.lit(0).cast("long")
    for i, part in enumerate(parts):
        others = "".join(c for c in every if c not in part)
        letters = F.array_join(F.array_sort(F.split(F.translate(word, others, ""), "")), "")
        code = code.bitwiseOR(F.shiftleft(F.xxhash64(letters).bitwiseAND(F.lit(255)), 8 * i))
    return code


def signatures(words: DataFrame, parts: list[str], least_length: int = LEAST_LENGTH) -> DataFrame:
    """One row a word and choice of two parts: (skip, key), and what the checks
    of a pair need."""
    def without(i: int, j: int) -> int:
        mask = ((1 << 64) - 1) & ~(255 << 8 * i) & ~(255 << 8 * j)
        return mask - (1 << 64) if mask >> 63 else mask

    half = least_length // 2
    coded = words.select(
        "word", "n", part_code(F.col("word"), parts).alias("code"),
        F.char_length("word").alias("size"),
        F.hash(F.substring("word", 1, half)).alias("head"),
        F.hash(F.substring("word", -half, half)).alias("tail"))
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                              F.col("code").bitwiseAND(F.lit(without(i, j))).alias("key"))
                     for i, j in combinations(range(len(parts)), APART)])
    return coded.select("*", F.inline(keys))


def near_pairs(words: DataFrame, least_length: int = LEAST_LENGTH, parts: int = PARTS) -> DataFrame:
    """(a, a_n, b, b_n), a before b: every two words at edit distance one, once.
    ``words``: (word, n) of ``least_length`` code points at least."""
    made = signatures(words, letter_parts(words, parts), least_length)
    keys = ["i", "j", "key"]
    sides = [made.select(*keys, *[F.col(c).alias(side + c) for c in made.columns if c not in keys])
             for side in ("a_", "b_")]
    apart = F.col("a_code").bitwiseXOR(F.col("b_code"))
    i_differs, j_differs = [apart.bitwiseAND(F.expr(f"shiftleft(255L, 8 * {part})")) != 0 for part in "ij"]
    # The first choice that leaves out every part in which the two differ.
    first = ((i_differs & j_differs)
             | ((F.col("i") == 0) & ~i_differs & (j_differs | (F.col("j") == 1)))
             | ((F.col("i") == 0) & (F.col("j") == 1) & ~j_differs))
    # One edit leaves the first or the last half of least_length in place.
    ends = (F.col("a_head") == F.col("b_head")) | (F.col("a_tail") == F.col("b_tail"))
    near = (ends & (F.abs(F.col("a_size") - F.col("b_size")) <= 1) & first
            & (F.col("a_word") < F.col("b_word")) & (F.levenshtein("a_word", "b_word", 1) == 1))
    # Signatures are many times the vocabulary that Spark measures: never broadcast.
    return sides[0].join(sides[1].hint("merge"), keys).filter(near).select(
        F.col("a_word").alias("a"), "a_n", F.col("b_word").alias("b"), "b_n")


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest count if that
    is ``ratio`` times the word's own."""
    both = F.inline(F.array(
        F.struct(F.col("a").alias("word"), (-F.col("b_n")).alias("less"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("word"), (-F.col("a_n")).alias("less"), F.col("a").alias("other"))))
    near = pairs.select(both).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct("less", "other")).alias("top"))
    is_form = -F.col("top.less") >= ratio * F.col("n")
    return words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("top.other")).alias("form"),
        F.when(is_form, -F.col("top.less")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: the last word that forms lead
    to. Chains halve each round; counts grow along them, so none is a ring."""
    state = materialize(formed.filter(F.col("form").isNotNull()).select(
        "word", F.col("form").alias("root")), "forms")
    for _ in range(MAX_ROUNDS):
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(state.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "forms")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        state = moved.select("word", "root")
    raise RuntimeError("forms did not settle")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      ratio: int = RATIO, damage_step: int | None = None) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the corpus."""
    words = materialize(vocabulary(docs, id_col, text_col, least_length, least_count, damage_step),
                        "vocabulary")
    pairs = near_pairs(words, least_length)
    formed = materialize(forms(words, pairs, ratio), "formed")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_groups(docs: DataFrame) -> DataFrame:
    """The query's rows: words after the contract's damage."""
    return spelling_variants(docs, damage_step=DAMAGE_STEP)
