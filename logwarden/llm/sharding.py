"""Minimax contiguous partition into shards (operator 5).

Texts that are equal form an atomic group. Groups are ordered by a 64-bit hash
of their text; a contiguous cut of that order into K shards is sought whose
largest shard is as small as can be. A group larger than an even share must
fill a shard by itself, so such groups (fewer than K) come first, one shard
each, and the rest is cut for the shards that are left: binary search over the
capacity, a greedy walk checks each one.

The walk needs only prefix sums of the sizes, so the driver holds sums of hash
prefixes (at most KNOTS new ones a round), not groups. Cutting at known prefixes
bounds the capacity from above; the walks for an even share and for that bound
enclose each cut. Prefixes in between that hold several groups are summed again
by longer prefixes, until all of them hold one group: then the cut is exact.

Defined results: null text has no bytes and forms one group with empty text;
repeated rows and null ids get slots of their own; extra columns are ignored;
an empty table gives no rows; with fewer groups than shards some shards are
empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

SHARDS = 40
#: Bytes that every row adds to its text.
OVERHEAD = 16
#: Sums of hash prefixes that a round brings to the driver (three longs each).
KNOTS = 1 << 16


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, place): place is the hash that orders groups."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("place"))


def cuts(sums: list[int], capacity: int, shards: int) -> list[int] | None:
    """Greedy cuts (prefix sums) at known positions, each shard as full as the
    capacity lets it be; None if the shards do not suffice."""
    at, found = 0, []
    while sums[-1] - at > capacity:
        reach = sums[bisect_right(sums, at + capacity) - 1]
        if reach <= at or len(found) == shards - 1:
            return None
        found.append(reach)
        at = reach
    return found


def least_capacity(sums: list[int], shards: int) -> int:
    """Smallest capacity for which cuts at known positions suffice."""
    low, high = -(-sums[-1] // shards), sums[-1]
    while low < high:
        middle = (low + high) // 2
        if cuts(sums, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def even_cuts(sums: list[int], capacity: int, shards: int) -> list[int]:
    """Cuts at known positions, each as near to an even share as the capacity
    lets it be (so that the last shards are not left short)."""
    least = [sums[-1]]                          # from here on the rest still fits
    for _ in range(shards - 1):
        least.append(sums[bisect_left(sums, least[-1] - capacity)])
    at, found = 0, []
    for k in range(1, shards):
        low = bisect_left(sums, least[shards - k])
        high = bisect_right(sums, at + capacity) - 1
        ideal = sums[-1] * k / shards
        i = bisect_left(sums, ideal)
        if i and ideal - sums[i - 1] <= sums[min(i, len(sums) - 1)] - ideal:
            i -= 1
        at = sums[max(low, min(i, high))]
        found.append(at)
    return found


def _enclosed(sums: list[int], shards: int, high: int) -> list[tuple[int, int]]:
    """For each cut, positions that enclose it for every capacity from an even
    share to ``high``."""
    share, early, late, out = -(-sums[-1] // shards), 0, 0, []
    for _ in range(shards - 1):
        early = sums[bisect_right(sums, min(early + share, sums[-1])) - 1]
        late = min(late + high, sums[-1])
        out.append((early, late))
    return out


def minimax_cuts(groups: DataFrame, shards: int, knots: int = KNOTS) -> list[int]:
    """First places (unsigned) of the second and later shards of a contiguous
    partition of ``groups`` (place, size) with the smallest largest shard."""
    bits = (knots - 1).bit_length()
    cells = _sums(groups, {0: {0}}, bits)        # (depth, prefix) -> bytes, groups
    while cells:
        order = sorted(cells, key=lambda c: c[1] << (64 - c[0]))
        sums = [0]
        for c in order:
            sums.append(sums[-1] + cells[c][0])
        high = least_capacity(sums, shards)
        coarse: dict[int, set[int]] = {}
        for early, late in _enclosed(sums, shards, high):
            for i in range(bisect_right(sums, early) - 1, min(len(order), bisect_left(sums, late))):
                depth, prefix = order[i]
                if cells[order[i]][1] > 1:
                    coarse.setdefault(depth, set()).add(prefix)
        if not coarse:
            starts = [bisect_left(sums, e) for e in even_cuts(sums, high, shards)]
            return [order[i][1] << (64 - order[i][0]) for i in starts if i < len(order)]
        n = sum(map(len, coarse.values()))
        finer = _sums(groups, coarse, max(1, (max(2, knots // n)).bit_length() - 1))
        for depth, prefixes in coarse.items():
            for prefix in prefixes:
                del cells[(depth, prefix)]
        cells.update(finer)
    return []


def _sums(groups: DataFrame, coarse: dict[int, set[int]], bits: int) -> dict:
    """(depth, prefix) -> (bytes, groups) of the prefixes ``bits`` longer than
    the given ones; one aggregation for each depth among them."""
    out = {}
    for depth, prefixes in coarse.items():
        deeper = min(64, depth + bits)
        inside = groups
        if depth:
            held = groups.sparkSession.createDataFrame([(_signed(p),) for p in prefixes], "prefix long")
            inside = groups.join(F.broadcast(held), _prefix(depth) == F.col("prefix"), "left_semi")
        for r in inside.groupBy(_prefix(deeper).alias("p")).agg(
                F.sum("size").alias("size"), F.count("*").alias("n")).collect():
            out[(deeper, r["p"] % (1 << 64))] = (r["size"], r["n"])
    return out


def _prefix(depth: int) -> Column:
    return F.col("place") if depth == 64 else F.shiftrightunsigned("place", 64 - depth)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _ordered(place: Column) -> Column:
    """Signed longs that sort as the unsigned places do."""
    return place.bitwiseXOR(F.lit(-(1 << 63)))


def shard_of(groups: DataFrame, shards: int, knots: int = KNOTS) -> Column:
    """Shard of a place: the large groups' own shards, then the cut ones."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    large: list[int] = []
    for r in groups.orderBy(F.desc("size"), "place").limit(shards).collect():
        if shards - len(large) < 2 or r["size"] * (shards - len(large)) <= total:
            break
        large.append(r["place"])
        total -= r["size"]
    rest = groups.filter(~F.col("place").isin(large)) if large else groups
    bounds = minimax_cuts(rest, shards - len(large), knots)
    shard = F.lit(len(large))
    for b in bounds:
        shard = shard + (_ordered(F.col("place")) >= F.lit(_signed(b ^ (1 << 63)))).cast("int")
    for i, place in enumerate(large):
        shard = F.when(F.col("place") == place, i).otherwise(shard)
    return shard.cast("int")


def shards(docs: DataFrame, n: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           knots: int = KNOTS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    rows = materialize(sized(docs, id_col, text_col), "sizes")
    groups = materialize(rows.groupBy("place").agg(F.sum("size").alias("size")), "groups")
    placed = rows.withColumn("shard", shard_of(groups, n, knots))
    order = [F.col("shard"), _ordered(F.col("place")), F.col(id_col)]
    # A range sort splits large groups over tasks; ids grow along each task.
    dealt = materialize(placed.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("at", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("at", 33)
    counts = dealt.groupBy("shard", task.alias("task")).agg(
        F.count("*").alias("rows"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("shard").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("shard").alias("s"), "task", (before - F.col("first")).alias("shift"))
    return dealt.join(starts, (dealt["shard"] == starts["s"]) & (task == starts["task"])).select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
