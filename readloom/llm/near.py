"""Links between near copies: blocks of texts that share a key, sketches that reject unlike pairs, whole shingle sets that decide.

First each text meets the earlier one of its block that agrees best with it, which joins most groups. Blocks that still hold
several components are then compared whole, but for pairs that are joined already: rows with a candidate bring their shingles
to the block, and a block gives at most one link for each component that it joins. No block is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.common import bucket_of, stash
from readloom.llm.components import components
from readloom.operators.groups import bounds, by_group

#: Texts, and shingles of these texts, that a part of a block holds.
MEMBERS, SHINGLES = 2048, 500_000
#: A block with more texts outside its largest component is parted by the rare shingles of its texts.
CROWDED = 65_536
#: Pairs of rows that are looked at, and pairs whose sketches are compared, at once.
PAIRS, SKETCHES = 1 << 18, 1 << 15

Pairs = Iterator[tuple[np.ndarray, np.ndarray]]


def all_pairs(cells: pd.DataFrame) -> Pairs:
    """(later, earlier) for all pairs of rows of each cell."""
    edges = bounds(cells["cell"].to_numpy())
    lane = np.arange(len(cells)) - np.repeat(edges[:-1], np.diff(edges))
    ends, done = np.cumsum(lane), 0
    while done < len(cells):
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, "right")))
        n = lane[done:upto]
        later = np.repeat(np.arange(done, upto), n)
        yield later, later - np.repeat(n, n) + np.arange(len(later)) - np.repeat(np.cumsum(n) - n, n)
        done = upto


@dataclass(frozen=True)
class Rule:
    """Texts are near if 100 times their common shingles reach `per_cent` times all of theirs. Pairs with fewer than `agree` bytes
    of their sketches in common are taken for unlike; `pairs` gives those of a cell's rows to look at."""

    per_cent: int
    agree: float
    pairs: Callable[[pd.DataFrame], Pairs] = all_pairs


def _candidates(cells: pd.DataFrame, rule: Rule, label: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (later, earlier, agreement) of rows of each cell that may be near: numbers of shingles not too far apart, sketches
    alike. Pairs of one label are left out."""
    shingles = cells["shingles"].to_numpy()
    sketches = np.frombuffer(b"".join(cells["sketch"]), np.uint8).reshape(len(cells), -1)
    for all_later, all_earlier in rule.pairs(cells):
        one, other = shingles[all_later], shingles[all_earlier]
        keep = 100 * np.minimum(one, other) >= rule.per_cent * np.maximum(one, other)
        if label is not None:
            keep &= label(all_later) != label(all_earlier)
        all_later, all_earlier = all_later[keep], all_earlier[keep]
        for at in range(0, len(all_later), SKETCHES):
            later, earlier = all_later[at : at + SKETCHES], all_earlier[at : at + SKETCHES]
            agreement = np.count_nonzero(sketches[later] == sketches[earlier], axis=1)
            keep = agreement >= rule.agree
            if keep.any():
                yield later[keep], earlier[keep], agreement[keep]


def _nearest(cells: pd.DataFrame, rule: Rule) -> Iterator[pd.DataFrame]:
    """The earlier row of its cell whose sketch agrees best with each row's."""
    best, dst = np.zeros(len(cells), np.int64), np.zeros(len(cells), np.int64)
    for later, earlier, agreement in _candidates(cells, rule):
        order = np.lexsort((earlier, -agreement, later))
        own, first = np.unique(later[order], return_index=True)
        first = order[first]
        better = agreement[first] > best[own]
        best[own[better]], dst[own[better]] = agreement[first[better]], earlier[first[better]]
    rows = np.flatnonzero(best)
    node = cells["node"].to_numpy()
    yield pd.DataFrame({"src": node[rows], "agreement": best[rows], "dst": node[dst[rows]]})


def _open_rows(cells: pd.DataFrame, rule: Rule) -> Iterator[pd.DataFrame]:
    """Rows with a candidate of another component in their cell."""
    component, open_ = cells["component"].to_numpy(), np.zeros(len(cells), bool)
    for later, earlier, _ in _candidates(cells, rule, lambda rows: component[rows]):
        open_[later] = open_[earlier] = True
    yield cells[open_]


def _exact_links(cells: pd.DataFrame, rule: Rule) -> Iterator[pd.DataFrame]:
    """Links that join components of a cell: all pairs of candidates are compared by their shingles, but those already joined.

    Cells are taken together while they have about SHINGLES shingles.
    """
    first = bounds(cells["cell"].to_numpy())
    before = np.append(0, np.cumsum(cells["shingles"].to_numpy()))[first]
    at = 0
    while at < len(first) - 1:
        upto = max(at + 1, int(np.searchsorted(before, before[at] + SHINGLES, "right")) - 1)
        yield _links_of(cells.iloc[first[at] : first[upto]].reset_index(drop=True), rule)
        at = upto


def _links_of(cells: pd.DataFrame, rule: Rule) -> pd.DataFrame:
    _, group = np.unique(cells["component"].to_numpy(), return_inverse=True)
    label = np.arange(int(group.max()) + 1)
    size = np.fromiter(map(len, cells["shingle_set"]), np.int64, len(cells)) // 8
    number = np.unique(np.frombuffer(b"".join(cells["shingle_set"]), np.uint64), return_inverse=True)[1]
    start = np.cumsum(size) - size
    own = np.zeros(int(number.max(initial=0)) + 1, bool)
    found: list[tuple[int, int]] = []
    for later, earlier, _ in _candidates(cells, rule, lambda rows: label[group[rows]]):
        rows, first = np.unique(later, return_index=True)
        for row, others in zip(rows, np.split(earlier, first[1:]), strict=True):
            mine = number[start[row] : start[row] + size[row]]
            own[mine] = True
            step = max(1, SHINGLES // int(size[others].max()))
            for at in range(0, len(others), step):
                part = others[at : at + step]
                part = part[label[group[part]] != label[group[row]]]
                if not len(part):
                    continue
                ends = np.cumsum(size[part])
                places = np.arange(ends[-1]) - np.repeat(ends - size[part] - start[part], size[part])
                common = np.add.reduceat(own[number[places]].astype(np.int64), ends - size[part])
                for other in part[100 * common >= rule.per_cent * (size[row] + size[part] - common)]:
                    a, b = label[group[row]], label[group[other]]
                    if a != b:
                        label[label == max(a, b)] = min(a, b)
                        found.append((row, other))
            own[mine] = False
    node = cells["node"].to_numpy()
    ends = np.array(found, np.int64).reshape(-1, 2)
    return pd.DataFrame({"src": node[ends[:, 0]], "dst": node[ends[:, 1]]})


def _are_near(one: pd.Series, other: pd.Series, per_cent: int) -> pd.Series:
    out = []
    for a, b in zip(one, other, strict=True):
        a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        common = len(np.intersect1d(a, b, assume_unique=True))
        out.append(100 * common >= per_cent * (len(a) + len(b) - common))
    return pd.Series(out, dtype="bool")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _mixed_keys(labelled: DataFrame) -> DataFrame:
    """`labelled(key, node, shingles, component)` of keys with several components; main is the one with the most texts."""
    by_component = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("weight"))
    most = F.max_by(F.struct("component", "n", "weight"), F.struct("n", "component"))
    of_key = by_component.groupBy("key").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"), most.alias("most")).filter("n > most.n")
    outside = {"main": F.col("most.component"), "outside": F.col("n") - F.col("most.n"), "outside_weight": F.col("weight") - F.col("most.weight")}
    return labelled.join(stash(of_key.withColumns(outside).drop("most")), "key")  # a table of its own, so that the join may split a large key


def _parted_by_rare_shingles(crowded: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Rows of crowded keys under keys that also hold a shingle, such that every near pair of a key still meets.

    Of two near texts, each has so many shingles in common with the other that at most 100 - `per_cent` of its hundred are its
    own: so among one more than these, the first in any one order, is one that both have. The order is that of how many texts of
    the key have a shingle, the rare ones first, so that a key's parts are small unless its texts are alike indeed.
    """

    @F.pandas_udf("array<long>")
    def opened(raw: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(x, np.int64) for x in raw])

    each = crowded.select("key", "node", "shingles", "component").join(sets, "node").select("key", "node", "shingles", "component", F.explode(opened("shingle_set")).alias("shingle"))
    each = stash(each)
    counted = each.groupBy("key", "shingle").agg(F.count(F.lit(1)).alias("texts"))
    rare = Window.partitionBy("key", "node").orderBy("texts", "shingle")
    own = F.floor(F.col("shingles") * (100 - per_cent) / 100).cast("int") + 1
    first = each.join(counted, ["key", "shingle"]).withColumn("_at", F.row_number().over(rare)).filter(F.col("_at") <= own)
    return first.filter("texts > 1").select("node", "shingles", "component", F.xxhash64("key", "shingle").alias("key"))


def _cells(rows: DataFrame) -> DataFrame:
    """Rows (cell, node, component) of cells that hold together any two texts of a key that are in different components.

    Of two such texts, one at least is outside the key's main component. So a key of more than a part gives cells of a group of
    those outside and a part of all. Parts have MEMBERS texts or SHINGLES shingles, about.
    """

    def pieces(n: str, weight: str) -> Column:
        return F.ceil(F.greatest(F.col(n) / MEMBERS, F.col(weight) / SHINGLES)).cast("int")

    parts, groups = pieces("n", "weight"), pieces("outside", "outside_weight")
    part, group = bucket_of(["node"], parts), bucket_of(["node"], groups)
    cell = lambda g, p: F.xxhash64("key", g, p)
    as_any = F.transform(F.sequence(F.lit(0), groups - 1), lambda g: cell(g, part))
    as_outside = F.transform(F.sequence(F.lit(0), parts - 1), lambda p: cell(group, p))
    own = F.when(parts == 1, F.array(cell(F.lit(0), F.lit(0)))).when(F.col("component") == F.col("main"), as_any).otherwise(F.array_union(as_any, as_outside))
    return rows.select("node", "component", F.explode(own).alias("cell"))


def sharing_keys(keyed: DataFrame) -> DataFrame:
    """The rows of `keyed(node, shingles, key)` whose key several have, with n (how many) and first (the least node of them)."""
    shared = stash(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first")).filter("n > 1"))
    return stash(keyed.join(shared, "key"))


def labels(dealt: DataFrame, signs: DataFrame, sets: DataFrame, rule: Rule, crowded_over: int = CROWDED) -> DataFrame:
    """node, component (the least node reachable) of the nodes with a near one among those that they share a key with.

    `dealt` as of `sharing_keys`; `signs(node, shingles, sketch, ...)` has what `rule` reads, `sets(node, shingle_set)` the sorted
    64-bit hashes. A key of many texts is split into cells that meet in full; one with over `crowded_over` texts outside its
    largest component is parted by rare shingles first, which loses no near pair either.
    """
    parts = F.ceil(F.col("n") / MEMBERS).cast("int")
    own_part = bucket_of(["node"], parts)
    firsts = dealt.filter((F.col("n") > MEMBERS) & (F.col("node") == F.col("first"))).select("key", "node", own_part.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    blocks = dealt.select("key", "node", own_part.alias("part")).union(firsts.filter("part != own").select("key", "node", "part"))
    blocks = blocks.select(F.xxhash64("key", "part").alias("cell"), "node")
    nearest = by_group(blocks.join(signs, "node"), "cell", ["node"], lambda x: _nearest(x, rule), "src long, agreement long, dst long")
    best = nearest.groupBy("src").agg(F.max(F.struct("agreement", "dst"))["dst"].alias("dst"))
    one, other = (sets.select(F.col("node").alias(n), F.col("shingle_set").alias(f"{n}_set")) for n in ("src", "dst"))
    near = F.pandas_udf(lambda a, b: _are_near(a, b, rule.per_cent), "boolean")("src_set", "dst_set")
    joined = stash(best.join(one, "src").join(other, "dst").filter(near).select("src", "dst"))
    first = components(joined)

    mixed = stash(_mixed_keys(_labelled(dealt.select("key", "node", "shingles"), first)))
    crowded = F.col("outside") > crowded_over
    cells = _cells(mixed.filter(~crowded))
    if not mixed.filter(crowded).isEmpty():
        cells = cells.union(_cells(_mixed_keys(_parted_by_rare_shingles(mixed.filter(crowded), sets, rule.per_cent))))
    held = cells.join(signs, "node")
    open_ = stash(by_group(held, "cell", ["node"], lambda x: _open_rows(x, rule), held.schema))
    more = by_group(open_.join(sets, "node"), "cell", ["node"], lambda x: _exact_links(x, rule), "src long, dst long")
    return components(joined.union(stash(more)))
