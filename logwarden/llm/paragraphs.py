"""Substring removal by paragraph MinHash banding (operator 3).

Shared passages stand anywhere in a line, so a paragraph here is a run of SPAN
words that begins where the content says so: among every WINDOW neighbouring
starts the one whose GRAM-word gram has the least hash. A passage of at least
SPAN + WINDOW - 1 words (47) therefore holds at least one paragraph wherever it
is pasted, and the same ones each time.

1. Equal paragraphs (by content) leave the earliest (smallest id, then place).
   Their rows are counted first, so only repeated ones are kept. Where removed
   paragraphs of a text begin and end, the words beside them go too as long as
   they agree with those beside the earliest: WINDOW - 1 words on each side, as
   a longer agreement would hold a paragraph of its own.
2. Near copies are sought among units: lines of SPAN to LONG words, and pieces
   of whole texts, cut where the hash of CUT_GRAM words is the least within
   REACH words on both sides (so ends come back after an edit; a piece has
   SPAN words at least, and is split after LONG). Units get a MinHash signature
   over their five-word shingles: BANDS bands of ROWS values, in one of which
   two units of similarity 0.8 meet with probability 0.998, of 0.4 with 0.45 and
   of 0.2 with 0.07. Units that meet in a band are verified by exact Jaccard
   similarity (0.8 or more), in blocks of bounded size. Shingles are worked out
   for these units only, once each.
3. Verified links form components; each leaves its earliest member. Of the
   others goes what lies between the first and the last shingle that the
   earliest holds too (all, if they are linked only by way of others).

What a row yields depends on that row alone, so steps that read the input again
agree whatever order its rows come in.

Defined results: null text counts as empty; texts shorter than SPAN words lose
nothing; letters A-Z count as lower case; null ids count as larger than all
others; rows that share an id are not earlier than each other at the same
place (repeated rows have equal results); extra columns are ignored by
``repeated_paragraphs`` and kept by ``cut_documents``; an empty table gives no
rows; texts of any length count whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, drop_scratch, materialize, release, shared_keys, text_hash, text_or_empty
from .components import components
from .simhash import forest
from .suffix_dedup import LAST_ID, sliding_least
from .word_ids import Hasher, column_bytes, mix, row_groups, word_bounds

SPAN, WINDOW, GRAM = 30, 18, 8
SHINGLE, SIMILARITY = 5, 0.8
LONG, CUT_GRAM, REACH = 256, 3, 31
BANDS, ROWS = 9, 3
#: Paragraphs of one band key compared in one block.
BLOCK = 256
#: Texts are taken in groups of about this many bytes: their arrays stay in a core's cache.
GROUP = 1 << 18
#: Starts handled in one pass (places must fit 24 bits).
STRETCH = 1 << 23

_PLACE = np.uint64((1 << 24) - 1)
_TO_LOWER = np.arange(256, dtype=np.uint8)
_TO_LOWER[ord("A"):ord("Z") + 1] += 32


class Finder:
    """Paragraphs of a string column."""

    def __init__(self):
        self.hasher = Hasher()
        self.hasher.value = self.hasher.value[_TO_LOWER]

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """(starts, ends, row, hash) of the words."""
        starts, ends = word_bounds(data, offsets)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
        return starts, ends, row, self.hasher.ranges(self.hasher.sums(data), starts, ends)

    def runs(self, words: np.ndarray, n: int) -> np.ndarray:
        """Hash of every ``n`` neighbouring words."""
        if len(words) < n:
            return np.zeros(0, np.uint64)
        self.hasher._grow(len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.hasher.power[:len(words)], out=sums[1:])
        return mix((sums[n:] - sums[:-n]) * self.hasher.inverse[:len(words) - n + 1])

    def column(self, column: pa.Array) -> dict[str, np.ndarray]:
        """row, gram, content, first and stop byte of every paragraph."""
        data, offsets = column_bytes(column)
        found = []
        for a, b in row_groups(offsets, GROUP):
            base = offsets[a]
            starts, ends, row, words = self.words(data[base:offsets[b]], offsets[a:b + 1] - base)
            grams, contents = self.runs(words, GRAM), self.runs(words, SPAN)
            at = self.starts(grams, row)
            found.append({"row": row[at] + a, "gram": grams[at], "content": contents[at],
                          "first": starts[at] - (offsets[a:b + 1] - base)[row[at]],
                          "stop": ends[at + SPAN - 1] - (offsets[a:b + 1] - base)[row[at]]})
        names = ("row", "gram", "content", "first", "stop")
        return {k: np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64)
                for k in names}

    def units(self, column: pa.Array) -> dict[str, np.ndarray]:
        """row, content, first and stop byte and band keys of every unit."""
        data, offsets = column_bytes(column)
        found = []
        for a, b in row_groups(offsets, GROUP):
            base = offsets[a]
            part, own = data[base:offsets[b]], offsets[a:b + 1] - base
            starts, ends, row, words = self.words(part, own)
            line = np.searchsorted(np.flatnonzero(part == ord("\n")), starts)
            at, stop = unit_bounds(words, self.runs(words, CUT_GRAM), row, line)
            if not len(at):
                continue
            self.hasher._grow(len(words) + 1)
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * self.hasher.power[:len(words)], out=sums[1:])
            keys = band_keys(self.runs(words, SHINGLE), at, stop - at - SHINGLE + 1, BANDS, ROWS)
            found.append({"row": row[at] + a, "content": self.hasher.ranges(sums, at, stop),
                          "first": starts[at] - own[row[at]], "stop": ends[stop - 1] - own[row[at]],
                          "keys": keys})
        empty = {"row": np.zeros(0, np.int64), "content": np.zeros(0, np.uint64),
                 "first": np.zeros(0, np.int64), "stop": np.zeros(0, np.int64),
                 "keys": np.zeros((0, BANDS), np.uint64)}
        return {k: np.concatenate([f[k] for f in found]) if found else v for k, v in empty.items()}

    def spots(self, data: np.ndarray, offsets: np.ndarray, row: np.ndarray, kind: np.ndarray,
              first: np.ndarray, stop: np.ndarray) -> dict[str, list[bytes | None]]:
        """Of spans of the rows' texts what ``_looked_up`` says."""
        starts, ends, _, words = self.words(data, offsets)
        runs = self.runs(words, SHINGLE)
        hashes, places, around, reach = ([None] * len(row) for _ in range(4))
        base = offsets[row]
        at, last = np.searchsorted(starts, base + first), np.searchsorted(starts, base + stop)
        begins, stops = starts.astype(np.int32), ends.astype(np.int32)
        units = np.flatnonzero(kind == SET)
        for k, x, y in zip(units.tolist(), at[units].tolist(), (last[units] - SHINGLE + 1).tolist()):
            own = runs[x:y]
            order = np.argsort(own, kind="stable")
            own = own[order]
            new = np.ones(len(own) + 1, bool)
            np.not_equal(own[1:], own[:-1], out=new[1:-1])
            hashes[k] = own[new[:-1]].tobytes()
            place = np.stack([begins[x + order[new[:-1]]], stops[x + SHINGLE - 1 + order[new[1:]]]]) - begins[x]
            places[k] = place.astype(np.uint16 if place.max() < 1 << 16 else np.uint32).tobytes()
        edges = np.flatnonzero(kind != SET)
        if len(edges):
            x, bound = at[edges], np.searchsorted(starts, offsets)
            begin, end = bound[row[edges]], bound[row[edges] + 1]
            near = np.arange(WINDOW)
            own = surroundings(words, x, begin, end)
            far = np.stack([begins[np.maximum(x[:, None] - near, begin[:, None])],
                            stops[np.minimum(x[:, None] + SPAN - 1 + near, end[:, None] - 1)]], 1)
            far = far - base[edges].astype(np.int32)[:, None, None]
            for k, a, r in zip(edges.tolist(), own, far):
                around[k], reach[k] = a.tobytes(), r.tobytes()
        return {"hashes": hashes, "places": places, "around": around, "reach": reach}

    def starts(self, grams: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Chosen starts, as word numbers."""
        n = len(row) - SPAN + 1
        if n < 1:
            return np.zeros(0, np.int64)
        fits = row[:n] == row[SPAN - 1:]
        out = []
        for at in range(0, n, STRETCH):                       # overlapping by a window
            stop = min(n, at + STRETCH + WINDOW - 1)
            keys = (grams[at:stop] & ~_PLACE) | np.arange(stop - at, dtype=np.uint64)
            if stop - at < WINDOW:
                break
            whole = fits[at:stop - WINDOW + 1] & fits[at + WINDOW - 1:stop] & (
                row[at:stop - WINDOW + 1] == row[at + WINDOW - 1:stop])
            least = sliding_least(keys, WINDOW)[whole]
            out.append(np.unique((least & _PLACE).astype(np.int64)) + at)
        # rows with fewer starts than a window choose one among them all
        start = np.flatnonzero(fits)
        if len(start):
            head = np.flatnonzero(np.r_[True, row[start[1:]] != row[start[:-1]]])
            size = np.diff(np.r_[head, len(start)])
            few = np.flatnonzero(size < WINDOW)
            for h, k in zip(head[few].tolist(), size[few].tolist()):
                own = start[h:h + k]
                out.append(own[[int(np.argmin(grams[own]))]])
        return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)


def unit_bounds(words: np.ndarray, cuts: np.ndarray, row: np.ndarray, line: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one word numbers of the units of rows of ``words``;
    ``cuts`` are the hashes of the CUT_GRAM words from each word on."""
    n = len(words)
    if n < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    most = np.iinfo(np.uint64).max
    key = np.full(n, most, np.uint64)
    same = row[:n - CUT_GRAM + 1] == row[CUT_GRAM - 1:]
    key[:n - CUT_GRAM + 1][same] = cuts[same]
    at = np.arange(n) + (row + 1) * REACH              # rows stand apart by REACH
    padded = np.full(int(at[-1]) + REACH + 1, most, np.uint64)
    padded[at] = key
    least = sliding_least(padded, REACH)
    cut = (key < least[at - REACH]) & (key <= least[at + 1])
    begins = np.r_[True, row[1:] != row[:-1]]
    first = np.flatnonzero(cut | begins)
    size = np.diff(np.r_[first, n])
    more = (size - 1) // LONG                          # split after LONG words
    step = np.arange(len(first) + int(more.sum())) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    first = np.repeat(first, more + 1) + step * LONG
    # a short piece joins the one before it, a short first one the next
    first = first[begins[first] | (np.diff(np.r_[first, n]) >= SPAN)]
    short = np.r_[False, (begins[first] & (np.diff(np.r_[first, n]) < SPAN))[:-1]]
    first = first[begins[first] | ~short]
    stop = np.r_[first[1:], n]
    head = np.flatnonzero(begins | np.r_[True, line[1:] != line[:-1]])
    end = np.r_[head[1:], n]
    fits = end - head <= LONG
    both = np.stack([np.r_[first, head[fits]], np.r_[stop, end[fits]]])
    both = np.unique(both[:, both[1] - both[0] >= SPAN], axis=1)
    return both[0], both[1]


def band_keys(values: np.ndarray, first: np.ndarray, size: np.ndarray,
              bands: int, rows: int) -> np.ndarray:
    """Band keys of sets of shingles, values[first:first + size] each (which may
    overlap), as rows of ``bands`` keys of ``rows`` least values. Values are
    well mixed, so their products with odd numbers serve as random orders."""
    salt = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    edges = np.stack([first, first + size], 1).ravel()
    values = np.r_[values, np.uint64(0)]               # an edge may be the end
    out = np.empty((len(first), bands), np.uint64)
    for b in range(bands):
        key = np.zeros(len(first), np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            key = mix((key ^ np.minimum.reduceat(values * salt[k], edges)[::2]) * salt[k])
        out[:, b] = key
    return out


#: What a place of a text is looked up for.
SET, BESIDE, END = 0, 1, 2
_PLACES = "id long, tag long, first int, stop int"
_REMOVED = f"{_PLACES}, source long"


def _found(docs: DataFrame, units: bool) -> DataFrame:
    """Every paragraph (or unit, with its band keys) of (id, text, tag) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            f = (finder.units if units else finder.column)(batch.column(1))
            row = pa.array(f["row"])
            columns = {"content": pa.array(f["content"].view(np.int64)), "id": batch.column(0).take(row),
                       "tag": batch.column(2).take(row), "first": pa.array(f["first"].astype(np.int32)),
                       "stop": pa.array(f["stop"].astype(np.int32))}
            if units:
                ends = pa.array(np.arange(len(row) + 1) * BANDS, pa.int32())
                columns["keys"] = pa.ListArray.from_arrays(ends, pa.array(f["keys"].ravel().view(np.int64)))
                columns["apart"] = pa.ListArray.from_arrays(ends, pa.array(keys_apart(f)))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, f"content long, {_PLACES}" + (
        ", keys array<long>, apart array<boolean>" if units else ""))


def keys_apart(units: dict[str, np.ndarray]) -> np.ndarray:
    """Of every band key of every unit whether its row holds two units with that
    key that do not overlap (a line and a piece of it are no copies)."""
    keys = units["keys"].ravel()
    if not len(keys):
        return np.zeros(0, bool)
    row, first, stop = (np.repeat(units[c], BANDS) for c in ("row", "first", "stop"))
    order = np.lexsort((keys, row))
    new = np.r_[True, (keys[order][1:] != keys[order][:-1]) | (row[order][1:] != row[order][:-1])]
    head = np.flatnonzero(new)
    apart = np.maximum.reduceat(first[order], head) >= np.minimum.reduceat(stop[order], head)
    out = np.empty(len(keys), bool)
    out[order] = apart[np.cumsum(new) - 1]
    return out


def _heads(rows: DataFrame) -> DataFrame:
    """(content, head) with the earliest place of each content."""
    return rows.groupBy("content").agg(F.min(F.struct("id", "first", "stop", "tag")).alias("head"))


def _later(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """The rows that are not their content's earliest, with its id as source."""
    return rows.join(heads.select("content", "head").hint("shuffle_hash"), "content").filter(
        F.struct("id", "first") > F.struct("head.id", "head.first")).select(
            "content", "id", "tag", "first", "stop", F.col("head.id").alias("source"))


def _run_ends(equal: DataFrame) -> DataFrame:
    """The first and the last removed paragraph of every run of overlapping ones
    in a text, with the sides (left, right) where the run ends. Rows that share
    id and text count once, so a window is as long as one text at most; they are
    dropped in the partitions that the window needs."""
    order = Window.partitionBy("id", "tag").orderBy("first")
    return equal.repartition("id", "tag").dropDuplicates(["id", "tag", "first"]).select(
        "*", F.coalesce(F.lag("stop").over(order) < F.col("first"), F.lit(True)).alias("left"),
        F.coalesce(F.lead("first").over(order) > F.col("stop"), F.lit(True)).alias("right")).filter(
            "left or right")


def surroundings(words: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of paragraphs at words ``at`` of texts with words begin to end - 1: the
    WINDOW - 1 words before (nearest first) and behind, as two rows of 31 hash
    bits each; zero where there is none."""
    near = np.arange(WINDOW - 1)
    place = np.stack([at[:, None] - 1 - near, at[:, None] + SPAN + near], 1)
    there = (place >= begin[:, None, None]) & (place < end[:, None, None])
    return np.where(there, words[np.where(there, place, 0)] >> np.uint64(32) | np.uint64(1),
                    np.uint64(0)).astype(np.uint32)


def agreed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading words that sides (the last axis) have in common."""
    return np.cumprod((a == b) & (a > 0), axis=-1).sum(axis=-1)


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tag, first, stop, source): all paragraphs to remove, as byte ranges
    (which may overlap), each with a document that keeps
    (or itself refers on to) its like. tag is
    a 64-bit hash of the text, so that rows sharing an id stay apart."""
    spark = docs.sparkSession
    bound_batches(spark)
    keyed = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"),
                        text_or_empty(F.col(f"`{text_col}`")).alias("text")).withColumn(
                            "tag", text_hash("text"))

    found = materialize(_found(keyed, units=False), "paragraphs")      # read twice
    met = materialize(shared_keys(found, "content", hint="shuffle_hash").drop("n"), "met-paragraphs")
    drop_scratch(found)
    first = materialize(_heads(met), "paragraph-heads")      # plain tables: a hot content can be split
    equal = materialize(_later(met, first), "equal-paragraphs")
    drop_scratch(met)
    ends = materialize(_run_ends(equal), "run-ends")
    beside = ends.select("content").distinct().join(first, "content").select("content", "head.*")
    units = materialize(_found(keyed, units=True), "units")
    heads = materialize(_heads(units), "unit-heads")
    equal_units = materialize(_later(units, heads), "equal-units")
    release(spark)
    members = materialize(band_members(units), "members")
    drop_scratch(units)
    several = materialize(heads.join(members.groupBy("content").agg(
        (F.max("n") > BLOCK).alias("crowded")), "content").select("content", "head.*", "crowded"), "variants")
    drop_scratch(heads)
    looked_up = materialize(_looked_up(keyed, several, beside, ends), "shingles")
    release(spark)
    sets = looked_up.filter(F.col("kind") == SET)
    roots = materialize(components(similar_links(members, sets.select(
        "content", "crowded", F.col("hashes").alias("shingles"))), "a", "b"), "roots")
    drop_scratch(members)
    joined = several.join(roots, several["content"] == roots["node"], "left").withColumn(
        "root", F.coalesce("component", "content"))
    kept = joined.groupBy("root").agg(F.min(F.struct("id", "first", "content", "tag", "stop")).alias("kept"))
    # a line and a piece of one text may overlap and be alike: not copies
    itself = (F.col("id") == F.col("kept.id")) & (F.col("tag") == F.col("kept.tag")) & (
        F.col("first") < F.col("kept.stop"))
    near = joined.join(kept, "root").filter(
        (F.struct("id", "first") > F.struct("kept.id", "kept.first")) & ~itself).select(
            "content", F.col("kept.content").alias("like"), F.col("kept.id").alias("source"))
    copies = materialize(_trimmed(near, sets).unionByName(_extended(looked_up)), "near-units")
    drop_scratch(looked_up)
    return equal.drop("content").unionByName(equal_units.drop("content")).unionByName(copies)


def _one_row_each(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text, columns of ``wanted``) for its (id, tag): rows of ``keyed`` that
    share both hold one text, of which one is taken; only such texts are
    shuffled for that."""
    names = ["id", "tag"]
    copies = keyed.groupBy(*names).agg(F.count("*").alias("copies"))
    known = materialize(wanted.join(copies, names), "wanted")
    once = keyed.join(known.filter("copies = 1"), names)
    again = keyed.join(known.filter("copies > 1"), names).dropDuplicates(names)
    return once.unionByName(again).drop("copies")


def _looked_up(keyed: DataFrame, heads: DataFrame, beside: DataFrame, ends: DataFrame) -> DataFrame:
    """What the texts say of places in them, each text being split once: of units
    (``heads``: SET) the hashes of their different shingles and the places (from
    the unit's first byte on, in 16 bits if that will do, else in 32) where each
    first begins and last stops; of the earliest paragraphs (``beside``:
    BESIDE) and those at the ends of runs (``ends``: END) their surroundings
    (around) and where the words there begin to the left and stop to the right
    (reach)."""
    more = {"source": "long", "left": "boolean", "right": "boolean", "crowded": "boolean"}

    def spot(kind: int, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), "content", "id", "tag", "first", "stop", *(
            F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in more.items()))

    spots = spot(SET, heads).unionByName(spot(BESIDE, beside)).unionByName(spot(END, ends))
    names = spots.columns
    wanted = spots.groupBy("id", "tag").agg(F.collect_list(F.struct(
        *(c for c in names if c not in ("id", "tag")))).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            held = batch.column("spans")
            edge = np.r_[0, np.cumsum(held.value_lengths().to_numpy())]
            spans = pa.RecordBatch.from_struct_array(held.flatten())
            row = np.repeat(np.arange(batch.num_rows), np.diff(edge))
            for a, b in row_groups(offsets, GROUP):
                own, base = spans.slice(edge[a], edge[b] - edge[a]), offsets[a]
                in_row = row[edge[a]:edge[b]]
                found = finder.spots(
                    data[base:offsets[b]], offsets[a:b + 1] - base, in_row - a,
                    *(own.column(c).to_numpy() for c in ("kind", "first", "stop")))
                columns = {c: own.column(c) for c in own.schema.names}
                columns |= {c: batch.column(c).take(pa.array(in_row)) for c in ("id", "tag")}
                columns |= {c: pa.array(values, pa.binary()) for c, values in found.items()}
                yield pa.RecordBatch.from_pydict({c: columns[c] for c in names + list(found)})

    return _one_row_each(keyed, wanted).mapInArrow(cut, (
        f"kind int, content long, {_REMOVED}, left boolean, right boolean, crowded boolean, "
        "hashes binary, places binary, around binary, reach binary"))


def _trimmed(near: DataFrame, sets: DataFrame) -> DataFrame:
    """The ranges of ``near`` units (content, like, source) without the words
    before the first and after the last shingle that ``like`` holds."""
    rows = near.join(sets.select("content", "id", "tag", "first", "stop", "hashes", "places"), "content").join(
        sets.select(F.col("content").alias("like"), F.col("hashes").alias("theirs")), "like").select(
            "id", "tag", "first", "stop", "source", "hashes", "places", "theirs")

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, stop = (batch.column(c).to_numpy().copy() for c in ("first", "stop"))
            for r, (mine, places, theirs) in enumerate(zip(*(
                    batch.column(c).to_pylist() for c in ("hashes", "places", "theirs")))):
                both = np.isin(np.frombuffer(mine, np.uint64), np.frombuffer(theirs, np.uint64),
                               assume_unique=True)
                if both.any():
                    kind = np.uint16 if len(places) * 2 == len(mine) else np.uint32
                    begin, end = np.frombuffer(places, kind).reshape(2, -1)[:, both]
                    first[r], stop[r] = first[r] + int(begin.min()), first[r] + int(end.max())
            yield _removed(batch, first, stop)

    return rows.mapInArrow(trim, _REMOVED)


def _extended(looked_up: DataFrame) -> DataFrame:
    """The ranges of the paragraphs at the ends of runs with the words beside
    them that agree with those beside the earliest (none where no word does)."""
    theirs = looked_up.filter(F.col("kind") == BESIDE).select("content", F.col("around").alias("theirs"))
    rows = looked_up.filter(F.col("kind") == END).join(theirs, "content").select(
        "id", "tag", "source", "left", "right", "around", "reach", "theirs")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, theirs, reach = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).reshape(batch.num_rows, 2, -1)
                for c, kind in (("around", np.uint32), ("theirs", np.uint32), ("reach", np.int32)))
            more = agreed(mine, theirs) * np.stack([np.asarray(batch.column(c)) for c in ("left", "right")], 1)
            longer = np.flatnonzero(more.any(axis=1))
            yield _removed(batch.take(pa.array(longer)), reach[longer, 0, more[longer, 0]],
                           reach[longer, 1, more[longer, 1]])

    return rows.mapInArrow(extend, _REMOVED)


def _removed(batch: pa.RecordBatch, first: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "id": batch.column("id"), "tag": batch.column("tag"), "first": pa.array(first, pa.int32()),
        "stop": pa.array(stop, pa.int32()), "source": batch.column("source")})


def band_members(units: DataFrame) -> DataFrame:
    """(key, content, n): the n different contents of every band key that has
    several, in more than overlapping units of one text; of keys with the same
    members one is kept. Rows meet by key once; counting and joining read the
    same shuffle."""
    # A unit goes by 32 bits of its text and 31 of its content; the last bit tells
    # of a unit of the same text with that key that it does not overlap.
    low = F.lit((1 << 32) - 2)
    named = units.withColumn("ref", F.shiftleft(F.hash("id", "tag").cast("long"), 32).bitwiseOR(
        F.shiftleft("content", 1).bitwiseAND(low)))
    rows = named.select("ref", F.inline(F.arrays_zip(
        F.col("keys").alias("key"), F.col("apart").alias("apart")))).select(
            "key", F.col("ref").bitwiseOR(F.col("apart").cast("long")).alias("ref")).repartition("key")
    text, content = F.shiftright("ref", 32), F.col("ref").bitwiseAND(low)
    shared = rows.groupBy("key").agg(
        (F.min(text) < F.max(text)).alias("texts"), (F.min(content) < F.max(content)).alias("contents"),
        F.max(F.col("ref").bitwiseAND(F.lit(1))).alias("apart")).filter(
            "(texts or apart = 1) and contents").select("key")
    refs = materialize(rows.join(shared.hint("shuffle_hash"), "key").select(
        "key", F.col("ref").bitwiseAND(F.lit(-2)).alias("ref")).distinct(), "met-refs")
    release(units.sparkSession)
    met = materialize(refs.hint("shuffle_hash").join(named.select("ref", "content").distinct(), "ref").select(
        "key", "content").distinct(), "met-keys")
    groups = materialize(met.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor("content").alias("x"),
        F.bit_xor(F.xxhash64("content")).alias("y")).groupBy("n", "x", "y").agg(
            F.min("key").alias("key")).select("key", "n"), "band-keys")
    return met.join(groups, "key")


def similar_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) links between contents that meet in a band (``members``: key,
    content, n) and whose ``sets`` (content, crowded, shingles) are similar; of
    each block a forest with the same components. crowded: the content is in a
    key of several blocks."""
    members = members.withColumn("block", F.pmod(F.xxhash64("content"), F.ceil(F.col("n") / BLOCK)))

    def blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
        """Shingles join only the members of keys that are left."""
        return members.join(sets, "content").groupBy("key", "block", "n").agg(
            F.collect_list(F.struct("content", "shingles")).alias("rows"))

    every = blocks(members, sets)
    alone = every.select("rows", F.lit(None).cast(every.schema["rows"].dataType).alias("others"))
    crowd = materialize(blocks(members.filter(F.col("n") > BLOCK), sets.filter("crowded")), "paragraph-blocks")
    other = crowd.select("key", F.col("block").alias("block2"), F.col("rows").alias("others"))
    across = crowd.join(other, "key").filter(F.col("block") < F.col("block2")).select("rows", "others")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for (names, sets), (more, more_sets) in zip(_sets(batch.column(0)), _sets(batch.column(1))):
                pairs = similar_pairs(sets + more_sets, len(sets) if more_sets else 0)
                if len(pairs):
                    names = np.concatenate([names, more])
                    child, root = forest(len(names), pairs)
                    a += names[child].tolist()
                    b += names[root].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])

    return alone.unionByName(across).mapInArrow(verify, "a long, b long")


def _sets(column: pa.Array) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Contents and shingles of each row (none, where it is null)."""
    flat = column.flatten()
    names, sets = flat.field("content").to_numpy(), [
        np.frombuffer(s, np.uint64) for s in flat.field("shingles").to_pylist()]
    edge = np.r_[0, np.cumsum(column.value_lengths().fill_null(0).to_numpy())].tolist()
    for x, y in zip(edge, edge[1:]):
        yield names[x:y], sets[x:y]


def similar_pairs(sets: list[np.ndarray], split: int = 0) -> np.ndarray:
    """Row pairs whose exact Jaccard similarity reaches SIMILARITY; with
    ``split`` only pairs of a row before it and one from it on."""
    size = np.array([len(s) for s in sets])
    if size.sum() == 0:
        return np.zeros((0, 2), np.int64)
    if len(sets) == 2:                                 # as most blocks are
        both = int(size.min())                         # at most
        if both >= SIMILARITY * size.max() - 1e-6:
            both = len(np.intersect1d(*sets, assume_unique=True))
        alike = bool(both >= SIMILARITY * (size.sum() - both) - 1e-6)
        return np.array([[0, 1]] if alike else [], np.int64).reshape(-1, 2)
    terms, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    held = count > 1                                   # others are in no two sets
    column = np.cumsum(held) - 1
    has = np.zeros((len(sets), int(held.sum())), np.float32)
    has[np.repeat(np.arange(len(sets)), size)[held[at]], column[at[held[at]]]] = 1
    left, right = (has[:split], has[split:]) if split else (has, has)
    both = left @ right.T
    union = size[:len(left), None] + size[split:][None, :] - both
    i, j = np.nonzero(both >= SIMILARITY * union - 1e-6)
    j = j + split
    keep = i < j
    return np.stack([i[keep], j[keep]], 1)


def removed_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first, stop, source_id): the removed byte ranges of each document's
    text and a document that holds the like earlier."""
    kind = docs.schema[id_col].dataType
    found = repeated_paragraphs(docs, id_col, text_col)
    name = F.when(F.col("id") != LAST_ID, F.col("id")).cast(kind)
    source = F.when(F.col("source") != LAST_ID, F.col("source")).cast(kind)
    return found.select(name.alias(id_col), "first", "stop", source.alias(f"source_{id_col}"))


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  length_col: str = "n_chars") -> DataFrame:
    """``docs`` without the removed paragraphs: same columns, texts cut, the
    length column (if there is one) counted anew. Documents of which nothing
    but white space is left go."""
    ranges = repeated_paragraphs(docs, id_col, text_col).groupBy("id", "tag").agg(
        F.collect_list(F.struct("first", "stop")).alias("ranges"))
    mark = "__"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    id_key, tag_key, found = f"{mark}id", f"{mark}tag", f"{mark}ranges"
    text = F.col(f"`{text_col}`")
    keyed = docs.withColumns({
        id_key: F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)),
        tag_key: text_hash(text_or_empty(text))})
    rows = keyed.join(ranges.select(F.col("id").alias(id_key), F.col("tag").alias(tag_key),
                                    F.col("ranges").alias(found)), [id_key, tag_key], "left")
    names, at = docs.columns, docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = [], []
            for value, held in zip(batch.column(at), batch.column(len(names))):
                value = value.as_py()
                if held.is_valid:
                    value = without_ranges(value, held.values)
                    keep.append(bool(value.strip(" \t\n\v\f\r")))
                else:
                    keep.append(True)
                texts.append(value)
            columns = batch.columns[:len(names)]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    done = rows.select(*[F.col(f"`{c}`") for c in names], found).mapInArrow(cut, docs.schema)
    if length_col in names:
        kind = docs.schema[length_col].dataType
        done = done.withColumn(length_col, F.length(text).cast(kind))
    return done


def without_ranges(text: str, ranges) -> str:
    """Text without byte ranges (which may overlap)."""
    data = np.frombuffer(text.encode(), np.uint8)
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, ranges.field("first").to_numpy(), 1)
    np.add.at(edge, ranges.field("stop").to_numpy(), -1)
    return data[np.cumsum(edge)[:-1] == 0].tobytes().decode()
