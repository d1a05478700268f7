"""Edit distances: the nearest reference of each sequence, pairs within a radius, references that have drifted."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.operators import edits
from readloom.operators.groups import bounds, by_group
from readloom.operators.kmers import windows
from readloom.sources.files import scratch

#: Letters of a part at most; parts have as many as a power of two.
LONGEST = 64


def _written(df: DataFrame) -> DataFrame:
    """`df` as rows in the shared folder, worked out once."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _part_length(length: Column, radius: int) -> Column:
    """Letters of a part, such that there are more parts than `radius`; 0 for sequences too short for that."""
    fitting = F.floor(length / (radius + 1))
    return F.when(fitting < 1, 0).otherwise(F.least(F.lit(LONGEST), F.pow(F.lit(2), F.floor(F.log2(fitting))).cast("int"))).cast("int")


def candidates(samples: DataFrame, references: DataFrame, radius: int) -> DataFrame:
    """id, reference: the pairs of `samples(id, seq)` and `references(reference, seq)` that may be within `radius` edits, and few others.

    A reference is cut into parts of one length. Each edit spoils one part at most, so of any radius + 1 parts a sequence within
    the radius has one whole, moved by no more than `radius` letters: those parts that fewest references have are taken. A
    sequence offers all its windows of that length. References of fewer letters than parts meet all sequences as short.
    """
    sized = references.filter("seq IS NOT NULL").withColumns({"size": F.length("seq"), "w": _part_length(F.length("seq"), radius)})
    found, probes = [], []
    lengths = [r.w for r in sized.select("w").distinct().collect()]  # a few powers of two
    for w in filter(None, lengths):
        own = sized.filter(F.col("w") == w)
        cut = own.select("reference", "size", "w", F.posexplode(F.regexp_extract_all("seq", F.lit(f"(.{{{w}}})"), 1)).alias("i", "part"))
        found.append(cut.select("reference", "size", "w", (F.col("i") * w).alias("at"), F.xxhash64("part").alias("part")))
        # a sample meets references whose length is within the radius of its own
        least, most = F.greatest(F.length("seq") - radius, F.lit(0)), F.length("seq") + radius
        near = samples.filter((_part_length(least, radius) <= w) & (_part_length(most, radius) >= w))
        probes.append(windows(near, "id", w).select("id", F.col("size").alias("own"), F.lit(w).alias("w"), "start", F.xxhash64("kmer").alias("part")))
    short = sized.filter("w = 0").select("reference", "size", "w", F.lit(0).alias("at"), F.lit(0).cast("long").alias("part"))
    brief = samples.filter(F.length("seq") <= 2 * radius).select("id", F.length("seq").alias("own"), F.lit(0).alias("w"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("part"))
    union = lambda frames: functools.reduce(DataFrame.unionByName, frames)
    if not lengths:
        return samples.select("id").join(references.select("reference"), F.lit(False))
    parts = _written(union([*found, short]))
    counted = parts.groupBy("w", "part").agg(F.count(F.lit(1)).alias("_held"))
    rare = Window.partitionBy("reference").orderBy("_held", "at")
    taken = parts.join(counted, ["w", "part"]).withColumn("_rank", F.row_number().over(rare)).filter(F.col("_rank") <= radius + 1).drop("_held", "_rank")
    met = union([*probes, brief]).join(taken, ["w", "part"])
    moved = (F.abs(F.col("start") - F.col("at")) <= radius) & (F.abs(F.col("own") - F.col("size")) <= radius)
    return met.filter(moved).select("id", "reference").distinct()


def within(samples: DataFrame, references: DataFrame, radius: int) -> DataFrame:
    """id, reference, distance of all pairs of `samples(id, seq)` and `references(reference, seq)` within `radius` edits, but for those of one name."""
    pairs = candidates(samples, references, radius).filter("id <> reference")
    both = pairs.join(samples.select("id", F.col("seq").alias("_one")), "id").join(references.select("reference", F.col("seq").alias("_other")), "reference")
    return both.select("id", "reference", F.levenshtein("_one", "_other", radius).alias("distance")).filter("distance >= 0")


#: Rows and letters of a tile: a task holds two tiles at a time. A short text, which profiles tell little of, counts as so many rows.
ROWS, ROOM, SHORT = 8192, 8_000_000, 8
#: Letters of the stretches that a profile counts, and its places, one for each stretch of A, C, G and T; the letters of texts whose stretches are counted at once.
GRAM, PLACES, CHUNK = 5, 4**5, 1 << 18
#: Hundredths of the places that have no more counts than each level of `_over`, and its words.
PARTED, WORDS = (40, 60, 80), PLACES // 64
#: Pairs that are compared at once.
PAIRS = 1 << 16
_NONE = np.iinfo(np.int64).max


def _profiles(texts: list[str]) -> np.ndarray:
    """How often each place of the profile is met by the stretches of each text; 255 stands for more."""
    out, sizes, at = np.zeros((len(texts), PLACES), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts)), 0
    while at < len(texts):
        n = max(1, min(1024, int(np.searchsorted(np.cumsum(sizes[at : at + 1024]), CHUNK))))
        some = sizes[at : at + n]
        codes = np.frombuffer("".join(texts[at : at + n]).encode("utf-32-le", "surrogatepass"), np.uint32) >> 1 & 3  # A, C, T and G differ
        if len(codes) >= GRAM:
            place = np.zeros(len(codes) - GRAM + 1, np.int64)
            for i in range(GRAM):
                place = place * 4 + codes[i : len(codes) - GRAM + 1 + i]
            whole = np.arange(len(place)) <= np.repeat(np.cumsum(some) - GRAM, some)[: len(place)]
            place += np.repeat(np.arange(n) * PLACES, some)[: len(place)]
            out[at : at + n] = np.minimum(np.bincount(place[whole], minlength=n * PLACES), 255).reshape(n, PLACES)
        at += n
    return out


def _over(profiles: np.ndarray) -> np.ndarray:
    """Bits of the places with over so many counts, for three numbers that part the places well; a profile a column, WORDS words for each number."""
    some = np.sort(profiles[:: len(profiles) // 64 + 1], axis=None)
    at = np.arange(3)
    levels = np.maximum.accumulate(np.maximum(some[[len(some) * k // 100 for k in PARTED]].astype(np.int64) - at, 0)) + at  # three different ones
    return np.ascontiguousarray(np.concatenate([np.packbits(profiles > t, axis=1).view(np.uint64) for t in levels], axis=1).T)


def _apart(bits: np.ndarray, own: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits ^ own[:, None]).sum(0, dtype=np.uint16)


def _met(one: np.ndarray, other: np.ndarray, texts: edits.Texts, wanted: Callable[[int, np.ndarray], np.ndarray], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of a text of `one` and one of `other` within `radius` edits, and their distances: of two tiles, or, if `other` is `one`, each pair of it once.

    Both are numbers of texts by rising length; `wanted` tells which pairs count. An edit changes GRAM stretches at most, so profiles
    differ by twice as many counts an edit at most; so do, in all, the places with over one number of counts, another and a third.
    """
    sizes, most, alone = texts.sizes, 2 * GRAM * radius, other is one
    rows = one if alone else np.concatenate([one, other])
    place = np.empty(len(sizes), np.int64)
    place[rows] = np.arange(len(rows))
    telling = GRAM * (radius + 1)  # shorter ones have too few stretches to differ by more
    if sizes[rows].max() >= telling:
        fine = _profiles([texts.texts[i] for i in rows.tolist()])
        bits, begin = _over(fine), 0 if alone else len(one)
        some = bits[:, :: len(rows) // 256 + 1]
        words = WORDS if np.median(_apart(some[:WORDS], some[:WORDS, -1])) > most else 2 * WORDS  # that are looked at for all
    long = sizes[other]
    low = np.arange(1, len(one) + 1) if alone else np.searchsorted(long, sizes[one] - radius)
    high = np.searchsorted(long, sizes[one] + radius, "right")
    held, n = [], 0
    for i, a, b in zip(one.tolist(), low.tolist(), high.tolist(), strict=True):
        if a >= b:
            continue
        near = other[a:b]
        if sizes[i] >= telling:
            own = place[i]
            apart = _apart(bits[:words, a + begin : b + begin], bits[:words, own])
            left = np.flatnonzero(apart <= most)
            if len(left):
                left = left[apart[left] + _apart(bits[words:, left + (a + begin)], bits[words:, own]) <= most]
            near = near[left]
            if len(near):
                counts = fine[left + (a + begin)]
                near = near[(np.maximum(counts, fine[own]) - np.minimum(counts, fine[own])).sum(1, dtype=np.int32) <= most]
        near = near[wanted(i, near)]
        if len(near):
            held.append((i, near))
            n += len(near)
        if n >= PAIRS:
            yield from _decided(held, texts, radius)
            held, n = [], 0
    yield from _decided(held, texts, radius)


def _decided(held: list[tuple[int, np.ndarray]], texts: edits.Texts, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    if held:
        first = np.repeat(np.array([i for i, _ in held]), [len(n) for _, n in held])
        second = np.concatenate([n for _, n in held])
        d = edits.within(texts, first, second, radius)
        yield first[d <= radius], second[d <= radius], d[d <= radius]


def _two_least(best: np.ndarray, row: np.ndarray, value: np.ndarray) -> None:
    """Into `best`, the least value and the next larger one of each row, go more of them."""
    before = best[0].copy()
    np.minimum.at(best[0], row, value)
    best[1] = np.minimum(best[1], np.where(before > best[0], before, _NONE))
    more = value > best[0][row]
    np.minimum.at(best[1], row[more], value[more])


def _of_cell(cell: pd.DataFrame, radius: int) -> pd.DataFrame:
    """text, own, distance, reference of the texts that ask, from one cell: of two tiles, or of one with itself."""
    cell = cell.iloc[np.argsort(cell["seq"].str.len().to_numpy(), kind="stable")]
    texts, kind = edits.Texts(cell["seq"].tolist()), pd.factorize(cell["kind"], use_na_sentinel=False)[0]
    asks, offers, tile = (cell[c].to_numpy() for c in ("asks", "offers", "tile"))
    names = np.array(sorted({*cell["first"][offers], *cell["second"][offers]}), object)
    known = {x: i for i, x in enumerate(names)}
    first, second = (np.fromiter((known.get(x, 0) for x in cell[c]), np.int64, len(cell)) for c in ("first", "second"))
    best = np.full((2, 2, len(cell)), _NONE)

    def put(row: np.ndarray, other: np.ndarray, d: np.ndarray) -> None:
        some = asks[row] & offers[other]
        row, other, d = row[some], other[some], d[some]
        same = kind[row] == kind[other]
        for name in (first, second):
            value = d * len(names) + name[other]
            _two_least(best[0], row, value)
            _two_least(best[1], row[same], value[same])

    each = bool(asks.all() and offers.all())
    wanted = lambda i, near: slice(None) if each else (offers[near] if asks[i] else False) | (asks[near] if offers[i] else False)
    if cell["alone"].iat[0]:
        own = np.arange(len(cell))
        put(own, own, np.zeros(len(cell), np.int64))
        one = other = own
    else:
        one, other = np.flatnonzero(tile == tile.min()), np.flatnonzero(tile > tile.min())
    if len(other):
        for a, b, d in _met(one, other, texts, wanted, radius):
            put(a, b, d), put(b, a, d)
    which, _, row = np.nonzero(best < _NONE)
    value = best[best < _NONE]
    return pd.DataFrame({"text": cell["text"].to_numpy(object)[row], "own": which == 1, "distance": value // max(1, len(names)), "reference": names[value % max(1, len(names))]})


def _closest(texts: DataFrame, radius: int) -> DataFrame:
    """text, own, distance, reference: of those of `texts(text, kind, seq, size, asks, offers, first, second)` that ask, the two of least (distance,
    reference) within `radius`, of the two least names of all that offer, and, where `own`, of those of the text's kind; each cell may give its own two.

    Texts lie in tiles of bounded size by their length, those of one unit of lengths by their hash; each two tiles that may hold texts of
    like length are a cell, as is each tile with itself, so that two texts meet once at most.
    """
    unit = F.floor(F.col("size") / max(radius, 1)).alias("unit")
    room = F.when(F.col("size") < 2 * GRAM * (radius + 1), SHORT).otherwise(1) * F.lit(ROOM) + F.col("size").cast("long") * F.lit(ROWS)  # of ROWS * ROOM in a tile
    by_unit = texts.groupBy(unit).agg(F.sum(room).alias("room"))
    along = Window.orderBy("unit")  # a row a unit of lengths
    upto = F.sum("room").over(along)
    units = by_unit.select("unit", "room", (upto - F.col("room")).alias("start"), upto.alias("end"))
    beside = lambda value, by: F.when(F.lag("unit", by).over(along) == F.col("unit") - by, F.lag(value, by).over(along)).otherwise(F.col(value))
    tile = lambda place: F.floor(place / (ROWS * ROOM))
    units = _written(units.select("unit", "room", "start", tile(beside("start", 1)).alias("least"), tile(beside("end", -1)).alias("most")))
    tasks = units.agg(F.max("most")).first()[0]
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / (1 << 20)
    placed = texts.withColumn("unit", unit).join(units, "unit").withColumn("tile", tile(F.col("start") + F.floor(F.col("room") * share)))
    met = placed.withColumn("_other", F.explode(F.sequence("least", "most")))
    cell = F.least("tile", "_other") * (1 << 31) + F.greatest("tile", "_other")
    cells = met.select("asks", "offers", "text", "kind", "seq", "first", "second", "tile", (F.col("tile") == F.col("_other")).alias("alone"), cell.alias("cell"))

    def run(groups: pd.DataFrame) -> Iterator[pd.DataFrame]:
        edges = bounds(groups["cell"].to_numpy())
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if groups["asks"].iloc[a:b].any():
                yield _of_cell(groups.iloc[a:b], radius)

    kind_of = T.StructType([T.StructField("text", T.StringType()), T.StructField("own", T.BooleanType()), T.StructField("distance", T.IntegerType()), T.StructField("reference", texts.schema["first"].dataType)])
    return by_group(cells, "cell", [], run, kind_of, 2 * (tasks or 0))


def nearest(samples: DataFrame, references: DataFrame | None, most: int, first: int = 8, growth: int = 4) -> DataFrame:
    """id, nearest, distance, own_nearest, own_distance of all `samples(id, kind, seq)`: the nearest of `references(reference, kind, seq)`
    by edit distance, and the nearest of the sample's own kind; of equals the smallest name. Null where none is within `most` edits.
    Without references these are the samples themselves, each for all others.

    A sample is looked at within `first` edits, and within `growth` times as many again as long as it has no reference of its own
    kind there. Equal texts of a kind go as one, with their two smallest names, as a sample may bear one of them, and whether they ask,
    offer or both, so two texts meet once. Texts meet all of like length, in cells of bounded size: counts of short stretches rule out
    most pairs in some ten nanoseconds, and `edits` decides the rest, in time that a text's length hardly matters for. Time grows with
    the square of the number of different texts of like length. Null sequences have no neighbour.
    """
    kind = F.col("kind").cast("string")
    text = F.sha2(F.concat(F.coalesce(F.length(kind).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(kind, F.lit("")), "seq"), 256)
    told = lambda df, name: _written(df.filter("seq IS NOT NULL").select(name, kind.alias("kind"), "seq", text.alias("text")))
    asked, found, radius = told(samples, "id"), [], min(first, most)
    offered = asked.withColumnRenamed("id", "reference") if references is None else told(references, "reference")
    name, left = offered.schema["reference"].dataType, asked.select("id", "text")
    each = offered.withColumn("asks", F.lit(references is None))
    if references is not None:
        each = each.unionByName(asked.drop("id").withColumns({"reference": F.lit(None).cast(name), "asks": F.lit(True)}))
    least = each.groupBy("text").agg(F.min("reference").alias("first"), F.any_value("kind").alias("kind"), F.any_value("seq").alias("seq"), F.bool_or("asks").alias("asks"))
    second = offered.select("text", "reference").join(least.select("text", "first"), "text").filter("reference <> first").groupBy("text").agg(F.min("reference").alias("second"))
    some = F.lit("0").cast(name)  # in place of a null, which would make numbers of another kind
    texts = known = _written(least.join(second, "text", "left").select("text", "kind", "seq", F.length("seq").alias("size"), "asks", F.col("first").isNotNull().alias("offers"), F.coalesce("first", some).alias("first"), F.coalesce("second", "first", some).alias("second")))
    while True:
        close = _closest(texts, radius)
        closer = F.struct("distance", "reference")
        pairs = _written(close).join(left.select("id", "text"), "text").filter("id <> reference")
        best = _written(pairs.groupBy("id").agg(F.min(F.when(~F.col("own"), closer)).alias("_any"), F.min(F.when(F.col("own"), closer)).alias("_own")))
        found.append(best.filter("_own IS NOT NULL") if radius < most else best)
        if radius >= most:
            break
        left = _written(left.join(best.filter("_own IS NOT NULL"), "id", "left_anti"))
        if left.isEmpty():
            break
        asking = left.select("text").distinct().withColumn("_asks", F.lit(True))
        texts = known.drop("asks").join(asking, "text", "left").withColumn("asks", F.col("_asks").isNotNull()).filter("asks OR offers")
        radius = min(radius * growth, most)
    of = functools.reduce(DataFrame.unionByName, found)
    each = of.select("id", F.col("_any.reference").alias("nearest"), F.col("_any.distance").alias("distance"), F.col("_own.reference").alias("own_nearest"), F.col("_own.distance").alias("own_distance"))
    return samples.select("id").join(each, "id", "left")


#: Longer consensus sequences aren't asked whether they have drifted, unless `longest` says otherwise.
TOO_LONG = 10_000


def drop_drifted(consensus: DataFrame, seeds: DataFrame, longest: int | None = TOO_LONG) -> DataFrame:
    """sample, name, seed_dist, other_dist, other_seed, kept of `consensus(sample, name, seq, reads)`, the references of each sample,
    with `seeds(sample, name, seq)`, the parts of their seeds that they were made from.

    A reference has drifted if the seed of another one that is left is nearer to its consensus than its own, or if its consensus is
    empty (or null). As long as a sample has several references, the drifted one of fewest reads goes (of equals the least name),
    and if others had drifted too, all is looked at anew without it: its seed no longer draws the others away. other_dist and
    other_seed are those of the nearest other seed at first, where it is nearer than the own one. A consensus of more than `longest`
    letters is never asked, though its seed draws others; with None all are.

    Distances are worked out once; a pass, over written tables, only asks which nearer seeds are left. The references of a sample
    are compared with one another, of which it has a few, as far as their own distance goes; samples only with themselves.
    """
    one = consensus.select("sample", "name", "reads", F.coalesce("seq", F.lit("")).alias("seq"))
    own = one.join(seeds.select("sample", "name", F.col("seq").alias("_seed")), ["sample", "name"], "left")
    state = _written(own.select("sample", "name", "reads", "seq", edits.edit_distance(F.col("seq"), F.col("_seed")).alias("seed_dist"), (F.col("seq") == "").alias("empty")))
    asked = state.filter(~F.col("empty") if longest is None else ~F.col("empty") & (F.length("seq") <= longest))
    others = seeds.select("sample", F.col("name").alias("other"), F.col("seq").alias("_seed")).join(state.select("sample", F.col("name").alias("other")), ["sample", "other"], "left_semi")
    measured = asked.join(others, "sample").filter("name <> other").filter(F.abs(F.length("seq") - F.length("_seed")) < F.col("seed_dist"))
    measured = measured.select("sample", "name", "other", "seed_dist", edits.edit_distance(F.col("seq"), F.col("_seed")).alias("distance"))
    nearer = _written(measured.filter("distance < seed_dist").drop("seed_dist"))

    left = _written(state.select("sample", "name", "reads", "empty"))
    going = left
    while True:
        pulled = nearer.join(left.select("sample", F.col("name").alias("other")), ["sample", "other"], "left_semi").select("sample", "name").distinct()
        drifted = going.join(pulled.withColumn("_pulled", F.lit(True)), ["sample", "name"], "left").withColumn("_drifted", F.col("empty") | F.col("_pulled").isNotNull())
        least = F.min(F.when(F.col("_drifted"), F.struct("reads", "name")))
        of_sample = _written(drifted.groupBy("sample").agg(F.count(F.lit(1)).alias("_n"), F.count_if("_drifted").alias("_drifted"), least.alias("_least")).filter("_n > 1 AND _drifted > 0"))
        gone = of_sample.select("sample", F.col("_least.name").alias("name"))
        left = _written(left.join(gone, ["sample", "name"], "left_anti"))
        going = left.join(of_sample.filter("_drifted > 1 AND _n > 2").select("sample"), "sample", "left_semi")
        if going.isEmpty():
            break
    closest = nearer.groupBy("sample", "name").agg(F.min(F.struct("distance", "other")).alias("_other"))
    kept = state.select("sample", "name", "seed_dist").join(closest, ["sample", "name"], "left").join(left.select("sample", "name", F.lit(True).alias("_kept")), ["sample", "name"], "left")
    return kept.select("sample", "name", "seed_dist", F.col("_other.distance").alias("other_dist"), F.col("_other.other").alias("other_seed"), F.coalesce("_kept", F.lit(False)).alias("kept"))
