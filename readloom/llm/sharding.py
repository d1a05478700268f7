"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts are packed, largest first, each into the bin with the tightest remaining capacity that still takes it.
Groups of one size are interchangeable, so the packing runs over the histogram of group sizes, and groups then take their
planned bins by their rank within the size. Different sizes number less than the root of twice the bytes of the corpus (60,000 of
them take 1.8 GB at least), so the histogram is small beside it. The capacity is looked for with the groups of more than a FINE-th
of a shard alone, of which there are FINE times the shards at most; the smaller ones then go on into the same bins, decreasing, up
to the level that evens the bins out. No shard passes it by more than the largest of them.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.common import bucket_of, numbered, stash

#: Groups of less than this part of a shard are packed after the capacity is found.
FINE = 1000
#: Rows that one numbering task may hold, and the most buckets that a key is dealt to.
ROWS_A_BUCKET, MOST_BUCKETS = 2_000, 4_096


class CapacityTree:
    """Bins by (remaining capacity, number) in a treap: a binary tree kept balanced by random priorities."""

    def __init__(self, seed: int = 0) -> None:
        self._root: list | None = None
        self._random = random.Random(seed)

    def add(self, remaining: int, number: int) -> None:
        left, right = self._split(self._root, (remaining, number))
        self._root = self._join(self._join(left, [(remaining, number), self._random.random(), None, None]), right)

    def pop_tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least remaining capacity of at least `size`."""
        left, right = self._split(self._root, (size, -1))
        if right is None:
            self._root = left
            return None
        node, parent = right, None
        while node[2] is not None:
            node, parent = node[2], node
        if parent is None:
            right = node[3]
        else:
            parent[2] = node[3]
        self._root = self._join(left, right)
        return node[0]

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """Nodes below the key, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _join(self, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return b if a is None else a
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b


def best_fit_decreasing(histogram: list[tuple[int, int]], capacity: int, most_bins: int | None = None, rooms: list[int] | None = None) -> list[tuple[int, int, int, int]] | None:
    """Runs (size, first rank, end rank, bin) of a best-fit-decreasing packing of `histogram` of (size, count).

    After a group enters the tightest bin, that bin is still the tightest one for its equals while it takes them, so they enter
    it together. A group beyond the capacity gets a bin of its own. None if more than `most_bins` would be needed. `rooms`: what
    bins that are open already still take.
    """
    tree, bins, runs = CapacityTree(), len(rooms or []), []
    for number, room in enumerate(rooms or []):
        tree.add(room, number)
    for size, count in sorted(histogram, reverse=True):
        rank = 0
        while rank < count:
            found = tree.pop_tightest(size)
            if found is None:
                if bins == most_bins:
                    return None
                found, bins = (max(capacity, size), bins), bins + 1
            remaining, number = found
            n = min(count - rank, remaining // size)
            runs.append((size, rank, rank + n, number))
            rank += n
            if remaining > n * size:
                tree.add(remaining - n * size, number)
    return runs


def pack_into(histogram: list[tuple[int, int]], shards: int, total: int | None = None, tries: int = 24) -> list[tuple[int, int, int, int]]:
    """The packing of the smallest capacity, found by bisection, for which best fit decreasing needs at most `shards` bins.

    `total`: what the bins are to hold in the end, if that is more than the histogram.
    """
    planned, largest = sum(s * n for s, n in histogram), max((s for s, _ in histogram), default=0)
    low = max(-(-max(planned, total or 0) // shards), largest)
    best = best_fit_decreasing(histogram, low, shards)
    high = low + largest  # a bin that would pass it leaves all others over the mean: always enough
    if best is None:
        best = best_fit_decreasing(histogram, high, shards)
        for _ in range(tries):
            middle = (low + high) // 2
            if middle in (low, high):
                break
            found = best_fit_decreasing(histogram, middle, shards)
            low, high, best = (low, middle, found) if found is not None else (middle, high, best)
    return best or []


def rooms_below(loads: list[int], rest: int) -> list[int]:
    """What each shard takes of `rest`, such that all that take something come to one level."""
    ordered, level, held = sorted(loads), 0.0, 0
    for i, load in enumerate(ordered, 1):
        held += load
        level = (held + rest) / i
        if i == len(ordered) or level <= ordered[i]:
            break
    return [max(0, round(level - load)) for load in loads]


def rooms_within(loads: list[int], rest: int, capacity: int, fine: int) -> list[int]:
    """What each shard takes of `rest`, which comes in groups of `fine` at most, without passing the capacity; more shards as needed."""
    rooms = [max(0, capacity - load - fine) for load in loads]
    return rooms + [max(1, capacity - fine)] * max(0, -(-(rest - sum(rooms)) // max(1, capacity - fine)))


def pack_rest(histogram: list[tuple[int, int]], loads: list[int], capacity: int | None, fine: int) -> list[tuple[int, int, int, int]]:
    """Best fit decreasing goes on with groups of `fine` at most: into bins that hold `loads`, and new ones of that capacity as
    needed, or without a capacity into those alone, each taking as little more than it has at an even level as will do."""
    rest = sum(size * n for size, n in histogram)
    if capacity:
        bins = len(rooms_within(loads, rest, capacity, fine))  # as many always do: of these an empty one is the last choice
        rooms = [max(0, capacity - load) for load in loads] + [capacity] * (bins - len(loads))
        return best_fit_decreasing(histogram, capacity, bins, rooms) or []
    rooms, more = rooms_below(loads, rest), 0
    while (runs := best_fit_decreasing(histogram, 0, len(loads), [room and room + more for room in rooms])) is None:
        more = min(2 * more + 1, fine + 1)  # with `fine` more, what finds no room would mean that more than all is packed
    return runs


def shard(docs: DataFrame, group: Column, size: Column, shards: int | None = 8, capacity: int | None = None) -> DataFrame:
    """`docs` with columns shard and slot (gapless from 0 within a shard) added; rows of equal `group` stay together.

    Give `shards` for that many shards of near-equal size, or `capacity` for as few shards of that capacity as best fit
    decreasing finds. Sizes must be positive. A group larger than a shard is still one group and makes its shard that large.
    A null group is a group. Repeated rows count each. Columns may have any names; those named shard and slot are replaced. An
    empty table gives no rows. `docs` should be a small projection (ids, not texts): it is written to the shared folder once.
    """
    rows = stash(docs.select(F.struct(*docs.columns).alias("doc"), group.alias("_group"), size.alias("_size")))
    groups = rows.groupBy("_group").agg(F.sum("_size").alias("_bytes"))
    groups = stash(groups)
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    fine = (capacity or -(-total // shards)) // FINE
    found = groups.groupBy("_bytes").agg(F.count(F.lit(1)).alias("n")).toPandas()
    histogram = list(zip(found["_bytes"].tolist(), found["n"].tolist(), strict=True))
    coarse, rest = [x for x in histogram if x[0] > fine], [x for x in histogram if x[0] <= fine]
    runs = best_fit_decreasing(coarse, capacity) if capacity else pack_into(coarse, shards, total)
    loads = [0] * (max((r[3] + 1 for r in runs), default=0) if capacity else shards)
    for size, first, end, number in runs:
        loads[number] += size * (end - first)
    runs += pack_rest(rest, loads, capacity, fine)
    spark = docs.sparkSession
    plan = spark.createDataFrame(pd.DataFrame(runs, columns=["_bytes", "_first", "_end", "shard"], dtype="int64"), "_bytes long, _first long, _end long, shard long")
    salts = plan.groupBy("_bytes").agg(F.ceil(F.max("_end") / ROWS_A_BUCKET).alias("_salts"))
    ranked = groups.join(salts, "_bytes").withColumn("_salt", bucket_of(["_group"], F.col("_salts"))).drop("_salts")
    ranked = numbered(ranked, ["_bytes"], "_salt", ["_group"], "_rank")
    placed = ranked.join(plan, "_bytes").filter("_rank >= _first AND _rank < _end").select("_group", F.col("shard").cast("int"))
    out = stash(rows.join(placed, rows["_group"].eqNullSafe(placed["_group"])).select("doc", "shard"))
    n = max(1, min(MOST_BUCKETS, rows.count() // ROWS_A_BUCKET))
    slotted = numbered(out.withColumn("_bucket", bucket_of(["doc"], n)), ["shard"], "_bucket", ["doc"], "slot")
    return slotted.select(*(F.col("doc")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")), "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Columns doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of `docs(doc_id, text)`.

    The law is `bytes`: groups of equal texts, by the sum of their UTF-8 bytes plus one each, fill the shards nearly equally.
    A null text has no bytes and is no copy of an empty one. grown_shard is null: adding a shard moves groups freely.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    key = F.unhex(F.when(F.col("text").isNull(), F.lit("")).otherwise(F.md5(text)))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    own = docs.select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), key.alias("_key"))
    out = shard(own, F.col("_key"), F.col("size"), shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
