"""Intervals on references: containment, overlap, merging, cover, gaps, lifting along alignments."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.operators import scans
from readloom.operators.groups import bounds, by_group
from readloom.sources.files import scratch

#: Positions of a bucket: intervals meet in the buckets they touch, so joins are on equal keys.
WIDTH = 1000


def buckets(start: Column, end: Column, width: int = WIDTH) -> Column:
    return F.sequence(F.floor(start / width), F.floor(end / width))


def containing(points: DataFrame, regions: DataFrame, key: str, position: str, width: int = WIDTH) -> DataFrame:
    """`points` joined to the `regions(key, name, start, end)` that hold their position, ends included."""
    cut = regions.select(F.col(key).alias("_key"), "name", "start", "end", F.explode(buckets(F.col("start"), F.col("end"), width)).alias("_bucket"))
    at = F.floor(F.col(position) / width)
    joined = points.join(cut, (points[key] == cut["_key"]) & (at == cut["_bucket"]))
    return joined.filter(F.col(position).between(F.col("start"), F.col("end"))).drop("_key", "_bucket")


def gene_bounds(landmarks: DataFrame, keep_stop: bool = False) -> DataFrame:
    """coordinates, name, start, end: a missing end is the base before the next start; a stop codon (stop not 'N') is dropped."""
    following = F.lead("start").over(Window.partitionBy("coordinates").orderBy("start"))
    end = F.coalesce("end", following - 1)
    return landmarks.select("coordinates", "name", "start", (end - F.when(F.lit(keep_stop) | (F.coalesce("stop", F.lit("")) == "N"), 0).otherwise(3)).alias("end"))


def first_matching(names: DataFrame, patterns: DataFrame, name: str = "seed") -> DataFrame:
    """name, coordinates of the first of `patterns(pattern, ord, coordinates)` that matches the whole name.

    Each distinct name is tried on the patterns, a configured list that is broadcast.
    """
    distinct = names.select(name).distinct()
    joined = distinct.join(F.broadcast(patterns), F.expr(f"{name} RLIKE concat('^(?:', pattern, ')$')"))
    return joined.groupBy(name).agg(F.min(F.struct("ord", "coordinates"))["coordinates"].alias("coordinates"))


def overlapping(spans: DataFrame, width: int = WIDTH) -> DataFrame:
    """id, other, and the other's bounds, for each pair of different intervals on one ref that share a position, in both orders.

    A pair meets in every bucket that both touch, and is kept in the one of the later start alone.
    """
    cut = spans.select("id", "ref", "r_st", "r_ei", "reads", F.explode(buckets(F.col("r_st"), F.col("r_ei"), width)).alias("b"))
    other = cut.select("ref", "b", *(F.col(c).alias(n) for c, n in (("id", "other"), ("r_st", "o_st"), ("r_ei", "o_ei"), ("reads", "o_reads"))))
    pairs = cut.join(other, ["ref", "b"]).filter("id <> other AND r_st <= o_ei AND o_st <= r_ei")
    return pairs.filter(F.floor(F.greatest("r_st", "o_st") / width) == F.col("b")).drop("b")


#: Positions are below 2^LEVELS.
LEVELS = 30


def _blocks(start: Column, end: Column) -> Column:
    """The fewest aligned blocks of 2^level positions that make up [start, end], as array<struct<level, block>>; none if empty."""
    none = F.array().cast("array<struct<level: int, block: bigint>>")
    begin = F.struct(start.cast("long").alias("a"), end.cast("long").alias("b"), none.alias("found"))

    def step(x: Column, level: Column) -> Column:
        own = lambda use, block: F.when(use, F.array(F.struct(level.alias("level"), block.alias("block")))).otherwise(none)
        found = F.concat(x["found"], own(x["a"] % 2 == 1, x["a"]), own(x["b"] % 2 == 0, x["b"]))
        up = F.struct(F.shiftright(x["a"] + 1, 1).alias("a"), F.shiftright(x["b"] - 1, 1).alias("b"), found.alias("found"))
        return F.when(x["a"] <= x["b"], up).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), begin, step)["found"]


def best_partner(spans: DataFrame) -> DataFrame:
    """id, partner: the longest overlapping interval, of equals that of the smallest id; intervals without one have no row.

    A partner either holds the interval's first position or starts within it. Of the intervals that hold an aligned block, and of
    those that start in one, only the longest (and its second, for itself) are kept, and a position or stretch asks its blocks:
    rows grow with the intervals and the logarithm of the positions, never with their pairs.
    """
    key = ["ref", "level", "block"]
    best = F.min(F.struct((F.col("r_st") - F.col("r_ei")).alias("len"), "id"))
    above = F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda n: F.struct(n.alias("level"), F.floor(F.col("r_st") / F.pow(F.lit(2.0), n)).cast("long").alias("block")))
    at = lambda blocks: spans.select("id", "ref", "r_st", "r_ei", F.explode(blocks).alias("x")).select("id", "ref", "r_st", "r_ei", "x.level", "x.block")
    holding = at(_blocks(F.col("r_st"), F.col("r_ei")))
    first = holding.groupBy(*key).agg(best.alias("first"))
    second = holding.join(first, key).filter(F.col("id") != F.col("first.id")).groupBy(*key).agg(best.alias("second"))
    held = at(above).select("id", *key).join(first, key).join(second, key, "left")
    one = held.select("id", F.when(F.col("first.id") != F.col("id"), F.col("first")).otherwise(F.col("second")).alias("p"))
    starting = at(above).groupBy(*key).agg(best.alias("p"))
    two = at(_blocks(F.col("r_st") + 1, F.col("r_ei"))).select("id", *key).join(starting, key).select("id", "p")
    return one.union(two).filter("p IS NOT NULL").groupBy("id").agg(F.min("p")["id"].alias("partner"))


def islands(spans: DataFrame, key: list[str], apart: int = 1) -> DataFrame:
    """`spans(key, r_st, r_ei, id, ...)` with island: those of a key that lie within `apart` positions of one another, and of one another's islands."""
    order = ["r_st", "r_ei", "id"]
    reached = scans.running(scans.laid(spans, key, order), key, order, {"_reached": ("max", F.col("r_ei"))}, own=False)
    marked = reached.withColumn("_new", F.when(F.col("r_st") <= F.col("_reached") + apart, 0).otherwise(1))
    return scans.running(marked, key, order, {"island": ("sum", F.col("_new"))}).drop("_reached", "_new", "_range")


def merge_intervals(spans: DataFrame) -> DataFrame:
    """ref, r_st, r_ei of overlapping or adjacent intervals merged; of those with one start, only the longest counts."""
    longest = spans.groupBy("ref", "r_st").agg(F.max("r_ei").alias("r_ei")).withColumn("id", F.lit(0))
    return islands(longest, ["ref"]).groupBy("ref", "island").agg(F.min("r_st").alias("r_st"), F.max("r_ei").alias("r_ei")).drop("island")


def covered_by_others(spans: DataFrame) -> DataFrame:
    """id, ref of intervals that one merged stretch of the intervals overlapping them covers, all seen at once; `without_covered` removes them one by one.

    A stretch that is larger covers. One of equal bounds covers if its intervals together have more reads, all of them known.

    Others cover an interval if no position of it has a depth of one. Their stretch is larger if some begin before it and go on
    into it, or go on after it. So sums along each reference answer: what began and ended before a position, and how many
    positions of depth one; each interval reads them at its start and behind its end. No pair of intervals is made.
    """
    key, order = ["ref"], ["pos"]
    unknown = F.col("reads").isNull().cast("long")
    begins = spans.select("ref", F.col("r_st").alias("pos"), F.lit(1).alias("begin"), F.lit(0).alias("end"), F.coalesce("reads", F.lit(0)).alias("reads"), unknown.alias("unknown"))
    ends = spans.select("ref", (F.col("r_ei") + 1).alias("pos"), F.lit(0).alias("begin"), F.lit(1).alias("end"), F.lit(0).alias("reads"), F.lit(0).alias("unknown"))
    events = begins.unionByName(ends).groupBy("ref", "pos").agg(*(F.sum(c).alias(c) for c in ("begin", "end", "reads", "unknown")))
    sums = {f"_{c}": ("sum", F.col(c)) for c in ("begin", "end", "reads", "unknown")}
    summed = scans.running(scans.laid(events, key, order), key, order, sums)
    ahead = scans.running(summed, key, order, {"_next": ("nearest", F.col("pos"))}, own=False, after=True)
    single = F.when(F.col("_begin") - F.col("_end") == 1, F.col("_next") - F.col("pos")).otherwise(0)
    known = scans.running(ahead.withColumn("single", single), key, order, {"_single": ("sum", F.col("single"))})
    going_on = F.col("_begin") - F.col("begin") - F.col("_end")
    before = lambda c: F.col(f"_{c}") - F.col(c)
    at = known.select("ref", "pos", going_on.alias("on"), *(before(c).alias(c) for c in ("reads", "unknown", "single")))
    start, behind = (at.select(F.col("ref").alias(f"{n}_ref"), F.col("pos").alias(f"{n}_pos"), *(F.col(c).alias(f"{n}_{c}") for c in ("on", "reads", "unknown", "single"))) for n in ("a", "b"))
    both = spans.join(start, (F.col("ref") == F.col("a_ref")) & (F.col("r_st") == F.col("a_pos"))).join(behind, (F.col("ref") == F.col("b_ref")) & (F.col("r_ei") + 1 == F.col("b_pos")))
    covered = F.col("a_single") == F.col("b_single")
    larger = (F.col("a_on") > 0) | (F.col("b_on") > 0)
    more = (F.col("a_unknown") == F.col("b_unknown")) & (F.col("b_reads") - F.col("a_reads") > 2 * F.col("reads"))
    return both.filter(covered & (larger | more)).select("id", "ref")


#: Of an interval: start, end, reads (None: unknown), and its place in the list.
Span = tuple[int, int, float | None, int]


def _is_covered(span: Span, left: Iterable[Span]) -> bool:
    """Whether one merged stretch of the others in `left` that overlap an interval covers it."""
    start, end, reads, place = span
    others = sorted((x for x in left if x[0] <= end and x[1] >= start and x[3] != place), key=lambda x: x[0])
    reach = start - 1
    for low, high, *_ in others:
        if low > reach + 1:
            return False
        reach = max(reach, high)
    if reach < end:
        return False
    if reach > end or others[0][0] < start:
        return True
    return reads is not None and all(x[2] is not None for x in others) and sum(x[2] for x in others) > reads


def _removed(left: dict[int, Span], by_reads: bool) -> Iterator[Span]:
    """Take from `left`, again and again, the least interval (by reads, or by length; of equals the first) that others cover.

    Removals shrink the cover of others, so the search goes on where it stopped; but where reads were unknown, those passed over
    for that reason may be covered now, and it begins anew.
    """
    order = sorted(left, key=lambda i: (left[i][2] if by_reads else left[i][1] - left[i][0], i))
    at = 0
    while at < len(order):
        span = left.get(order[at])
        if span is None or not _is_covered(span, left.values()):
            at += 1
            continue
        del left[span[3]]
        yield span
        if span[2] is None:
            at = 0


def _rank(span: Span) -> tuple[int, int]:
    return span[1] - span[0], span[3]


def _passes(spans: list[Span], until: tuple[int, int] | None) -> Iterator[tuple[Span, bool, tuple[int, int] | None]]:
    """Each interval of an island, whether it stays, and when it went.

    Where some reads are unknown anywhere in the sample, the least is the shortest. `until`: at that rank the last interval of unknown
    reads goes, and the least is from then on the one of fewest reads; None: that doesn't happen. An interval that is found late,
    after longer ones, went when they did: its rank is theirs.
    """
    left = {x[3]: x for x in spans}
    unknown = sum(x[2] is None for x in spans)
    rank, went = (-1, -1), {}
    if until is None or until >= (0, 0):
        kept = dict(left)
        for span in _removed(kept, by_reads=False):
            if until is not None and max(rank, _rank(span)) > until:
                break
            rank = max(rank, _rank(span))
            went[span[3]] = rank
            del left[span[3]]
            unknown -= span[2] is None
            if rank == until and not unknown:
                break
    if until is not None:
        for span in _removed(left, by_reads=True):
            went[span[3]] = None
    for span in spans:
        yield span, span[3] in left, went.get(span[3])


def without_covered(spans: DataFrame, key: list[str]) -> DataFrame:
    """Of `spans(key, id, r_st, r_ei, reads)`, those that stay when the least that the others cover is removed, again and again.

    Cover is one merged stretch of the overlapping others: a larger one, or one of equal bounds whose reads, all known, are more
    together. The least has the fewest reads; the shortest length as long as any of the key's left has unknown reads; of equals
    the smallest id. Only overlapping intervals bear on one another, so a key's islands are gone through each by itself: first as
    if by length to the end, which tells whether and when the key's last interval of unknown reads goes, then as it is.
    """
    columns = [*key, "id", "r_st", "r_ei", "reads"]
    path = scratch(spans.sparkSession)
    held = islands(spans.select(*columns), key, apart=0)
    held.withColumn("_island", F.to_json(F.struct(*key, "island"))).drop("island").write.parquet(path)
    rows = spans.sparkSession.read.parquet(path)

    def gone_through(more: list[str]) -> Callable[[pd.DataFrame], Iterator[pd.DataFrame]]:
        def run(groups: pd.DataFrame) -> Iterator[pd.DataFrame]:
            edges = bounds(groups["_island"].to_numpy()).tolist()
            reads = [None if pd.isna(r) else r for r in groups["reads"].tolist()]
            all_spans = list(zip(groups["r_st"].tolist(), groups["r_ei"].tolist(), reads, groups["id"].tolist(), strict=True))
            until = [None if pd.isna(a) else (int(a), int(b)) for a, b in zip(groups["_length"], groups["_id"], strict=True)] if more else [None] * len(groups)
            stays, length, place = [], [], []
            for first, end in zip(edges[:-1], edges[1:], strict=True):
                for _, stay, rank in _passes(all_spans[first:end], until[first]):
                    stays.append(stay)
                    length.append(rank and rank[0])
                    place.append(rank and rank[1])
            yield groups[columns].assign(_stays=stays, _length=pd.array(length, "Int64"), _id=pd.array(place, "Int64"))

        return run

    schema = T.StructType([*(rows.schema[c] for c in columns), T.StructField("_stays", T.BooleanType()), T.StructField("_length", T.LongType()), T.StructField("_id", T.LongType())])
    first = by_group(rows, "_island", ["id"], gone_through([]), schema)
    unknown = F.col("reads").isNull()
    last = F.max(F.when(unknown, F.struct("_length", "_id")))
    until = first.groupBy(*key).agg(F.bool_or(unknown & F.col("_stays")).alias("_open"), last.alias("_last"))
    rank = lambda c: F.when(~F.col("_open"), F.coalesce(F.col(f"_last.{c}"), F.lit(-1)))
    known = until.select(*(F.col(k).alias(f"_of_{k}") for k in key), rank("_length").alias("_length"), rank("_id").alias("_id"))
    same = functools.reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in key))
    timed = rows.join(known, same).drop(*(f"_of_{k}" for k in key))
    return by_group(timed, "_island", ["id"], gone_through(["_length"]), schema).filter("_stays").select(*columns)


def gaps_covered(spans: DataFrame, longer_than: int = 21) -> DataFrame:
    """ref, gap_st, gap_ei: gaps between neighbours of one strand of ids (even, odd) that an interval of the other strand overlaps."""
    key, order = ["ref", "strand"], ["r_st", "r_ei", "id"]
    strand = spans.withColumn("strand", F.col("id") % 2)
    following = scans.running(scans.laid(strand.select(*key, *order), key, order), key, order, {"_next": ("nearest", F.col("r_st"))}, own=False, after=True)
    gaps = following.withColumns({"gap_st": F.col("r_ei") + 1, "gap_ei": F.col("_next") - 1}).filter(F.col("gap_ei") - F.col("gap_st") + 1 > longer_than).select(*key, "gap_st", "gap_ei").distinct()
    cut = gaps.withColumn("b", F.explode(buckets(F.col("gap_st"), F.col("gap_ei"))))
    others = strand.select("ref", (1 - F.col("strand")).alias("strand"), "r_st", "r_ei", F.explode(buckets(F.col("r_st"), F.col("r_ei"))).alias("b"))
    met = cut.join(others, (cut["ref"] == others["ref"]) & (cut["strand"] == others["strand"]) & (cut["b"] == others["b"]) & (F.col("r_st") <= F.col("gap_ei")) & (F.col("gap_st") <= F.col("r_ei")), "left_semi")
    return met.select("ref", "gap_st", "gap_ei").distinct()


def out_of_order(spans: DataFrame) -> DataFrame:
    """ref, id, moved, before_end, after_start: whether its place by query start differs from that by reference start; neighbours by query.

    The query start is id order here: contigs are numbered along the query.
    """
    key = ["ref"]
    by_query = scans.laid(spans.select("ref", "id", "r_st", "r_ei"), key, ["id"])
    placed = scans.running(by_query, key, ["id"], {"_query": ("sum", F.lit(1))})
    before = scans.running(placed, key, ["id"], {"before_end": ("nearest", F.col("r_ei"))}, own=False)
    both = scans.running(before, key, ["id"], {"after_start": ("nearest", F.col("r_st"))}, own=False, after=True).drop("_range")
    by_ref = scans.running(scans.laid(both, key, ["r_st", "id"]), key, ["r_st", "id"], {"_ref": ("sum", F.lit(1))})
    return by_ref.select("ref", "id", (F.col("_query") != F.col("_ref")).alias("moved"), "before_end", "after_start")


def runs_of_positions(rows: DataFrame, key: list[str], position: str, step: int = 1) -> DataFrame:
    """key, first, last, n of positions that follow one another by `step`."""
    placed = scans.running(scans.laid(rows, key, [position]), key, [position], {"_row": ("sum", F.lit(1))})
    return placed.withColumn("_island", F.col(position) - step * F.col("_row")).groupBy(*key, "_island").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count(F.lit(1)).alias("n")).drop("_island")


def deletion_groups(positions: DataFrame, key: list[str], gap: int = 13) -> DataFrame:
    """key, first, last, n, anchor (the middle one) of deletion positions with no `gap` between them, if they span less than it and make whole codons."""
    order = Window.partitionBy(*key).orderBy("pos")
    new = F.coalesce((F.col("pos") - F.lag("pos").over(order) >= gap).cast("int"), F.lit(0))
    marked = positions.withColumn("_new", new).withColumn("_g", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    middle = F.get(F.array_sort(F.collect_list("pos")), F.floor(F.count(F.lit(1)) / 2).cast("int"))
    grouped = marked.groupBy(*key, "_g").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count(F.lit(1)).alias("n"), middle.alias("anchor"))
    return grouped.filter((F.col("last") - F.col("first") < gap) & (F.col("n") % 3 == 0)).drop("_g")


def shifted_deletions(groups: DataFrame, frame: Column) -> DataFrame:
    """`groups` with new_first: as one run around the anchor, moved by a base, if needed, onto the codon boundary of its reading frame."""
    start = F.col("anchor") - F.floor(F.col("n") / 2)
    phase = (start + frame) % 3
    return groups.withColumn("new_first", start + F.when(phase == 1, -1).when(phase == 2, 1).otherwise(0))


def lifted(tokens: DataFrame, key: list[str]) -> DataFrame:
    """key, query_pos, ref_pos (from 1) along M tokens; D tokens give rows without query_pos, I tokens without ref_pos."""
    each = tokens.filter("op <> 'S' AND len > 0").select(*key, "pos", "op", "q0", "r0", F.explode(F.sequence(F.lit(0), F.col("len") - 1)).alias("i"))
    query = F.when(F.col("op") != "D", F.col("q0") + F.col("i") + 1)
    ref = F.when(F.col("op") != "I", F.col("pos") + F.col("r0") + F.col("i"))
    return each.select(*key, "op", query.cast("long").alias("query_pos"), ref.cast("long").alias("ref_pos"))
