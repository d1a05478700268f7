"""Ordered calculations along positions: concordance, run lengths, smoothing, spikes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bad_cycles(quality: DataFrame, limit: float = 7.5) -> DataFrame:
    """Rows of `quality(tile, cycle, errorrate)` from the first bad or missing error rate of a tile's direction on."""
    order = Window.partitionBy("tile", F.col("cycle") < 0).orderBy(F.abs("cycle")).rowsBetween(Window.unboundedPreceding, 0)
    bad = F.max(F.coalesce(F.col("errorrate") >= limit, F.lit(True))).over(order)
    return quality.withColumn("_bad", bad).filter("_bad").drop("_bad")


def bad_tiles(quality: DataFrame, limit: float = 7.5) -> DataFrame:
    tiles = quality.select("tile").distinct()
    n = bad_cycles(quality, limit).groupBy("tile").agg(F.count(F.lit(1)).alias("bad_cycles"))
    return tiles.join(n, "tile", "left").fillna(0)


def trailing_concordance(rows: DataFrame, key: list[str], width: int = 20) -> DataFrame:
    """key, position, pct_concordance, pct_covered of `rows(pos, match, covered)`: full windows of `width`, reported at their centre."""
    order = Window.partitionBy(*key).orderBy("pos")
    last = order.rowsBetween(1 - width, 0)
    whole = rows.withColumns({"_n": F.row_number().over(order), "_m": F.sum("match").over(last), "_c": F.sum("covered").over(last)})
    return whole.filter(F.col("_n") >= width).select(*key, (F.col("_n") - width // 2).alias("position"), (100 * F.col("_m") / width).alias("pct_concordance"), (100 * F.col("_c") / width).alias("pct_covered"))


def centred_concordance(rows: DataFrame, key: list[str], half: int = 10) -> DataFrame:
    """key, pos, concordance over the positions from `half` before to `half` - 1 after, as many as there are."""
    near = Window.partitionBy(*key).orderBy("pos").rowsBetween(-half, half - 1)
    return rows.select(*key, "pos", F.avg("match").over(near).alias("concordance"))


def full_windows(rows: DataFrame, key: list[str], value: str, width: int = 31) -> DataFrame:
    """key, pos, mean over the positions within width // 2, where all `width` exist."""
    near = Window.partitionBy(*key).orderBy("pos").rangeBetween(-(width // 2), width // 2)
    whole = rows.select(*key, "pos", F.count(F.lit(1)).over(near).alias("_n"), F.avg(value).over(near).alias("mean"))
    return whole.filter(F.col("_n") == width).drop("_n")


def true_runs(rows: DataFrame, key: list[str], order: str, flag: Column) -> DataFrame:
    """`rows` with forward and backward: how many true values end, and begin, at each."""
    up = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*key).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("_f", flag.cast("int"))
    for name, w in (("forward", up), ("backward", down)):
        out = out.withColumn("_c", F.sum("_f").over(w))
        out = out.withColumn(name, F.col("_c") - F.max(F.when(F.col("_f") == 0, F.col("_c")).otherwise(0)).over(w))
    return out.drop("_f", "_c")


def concordance_scores(rows: DataFrame, key: list[str], order: str, flag: Column) -> DataFrame:
    """key, order, score (roots of the runs of matches less those of mismatches) and norm (from 0 to 1; all equal: 1 if positive)."""
    up = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*key).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    both = rows.select(*key, order, flag.cast("int").alias("_f"))
    for w in (up, down):  # how many equal flags end, or begin, at each
        both = both.withColumns({"_p": F.sum("_f").over(w), "_m": F.sum(1 - F.col("_f")).over(w)})
        run = lambda n, other: F.col(n) - F.max(F.when(F.col("_f") == other, F.col(n)).otherwise(0)).over(w)  # noqa: B023, E731
        step = "1" if w is up else "2"
        both = both.withColumns({f"_a{step}": F.sqrt(run("_p", 0)), f"_b{step}": F.sqrt(run("_m", 1))})
    both = both.withColumns({n: F.col(f"{n}1") + F.col(f"{n}2") for n in ("_a", "_b")})
    whole = Window.partitionBy(*key)
    scored = both.withColumn("score", F.round(F.col("_a") - F.col("_b"), 9))
    low, high = F.min("score").over(whole), F.max("score").over(whole)
    norm = F.when(high == low, (F.col("score") > 0).cast("double")).otherwise((F.col("score") - low) / F.when(high != low, high - low))
    return scored.select(*key, order, "score", norm.alias("norm"))


def best_cut(scored: DataFrame, key: list[str], order: str) -> DataFrame:
    """key, cut: the position of the highest score; of equals the furthest from both ends, then the first."""
    whole = Window.partitionBy(*key)
    place = F.row_number().over(whole.orderBy(order)) - 1
    numbered = scored.withColumns({"_i": place, "_n": F.count(F.lit(1)).over(whole)})
    inner = F.when(F.col("_i") < F.col("_n") / 2, F.col("_i")).otherwise(F.col("_n") - F.col("_i") - 1)
    ranked = numbered.withColumn("_inner", inner).withColumn("_k", F.row_number().over(whole.orderBy(F.desc("score"), F.desc("_inner"), "_i")))
    return ranked.filter("_k = 1").select(*key, F.col(order).alias("cut"))


def direction_changes(rows: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """key, changes: how often consecutive differences change their sign."""
    w = Window.partitionBy(*key).orderBy(*order)
    step, before = F.col(value) - F.lag(value).over(w), F.lag(value).over(w) - F.lag(value, 2).over(w)
    return rows.select(*key, (step * before < 0).alias("_t")).groupBy(*key).agg(F.count_if("_t").alias("changes"))


def length_spikes(counts: DataFrame, radius: int = 20, ratio: int = 20) -> DataFrame:
    """length, n of local maxima that are `ratio` times the third quartile of the lengths around them, missing lengths being 0.

    Lengths, of which there are as many as the longest read has bases, are ordered as a whole.
    """
    top = counts.agg(F.max("length")).select(F.explode(F.sequence(F.lit(-radius).cast("long"), F.col("max(length)") + radius)).alias("length"))
    dense = top.join(counts, "length", "left").fillna(0, ["n"])
    order = Window.orderBy("length")
    near = F.sort_array(F.collect_list("n").over(order.rowsBetween(-radius, radius)))
    width = 2 * radius + 1
    quartile = F.element_at(F.col("_w"), -(-(-width // 4)))
    marked = dense.withColumns({"_w": near, "_a": F.coalesce(F.lag("n").over(order), F.lit(0)), "_b": F.coalesce(F.lead("n").over(order), F.lit(0))})
    spikes = marked.filter((F.size("_w") == width) & (F.col("length") >= radius) & (F.col("_a") <= F.col("n")) & (F.col("n") > F.col("_b")))
    return spikes.filter(F.col("n") >= ratio * F.greatest(quartile, F.lit(0.5))).select("length", "n")


def neighbour_ratios(counts: DataFrame, reach: tuple[int, ...] = (3, 4, 5, 6, 7)) -> DataFrame:
    """length, reach, ratio of a length's count to the mean of its neighbours within reach, itself left out; lengths without neighbours go."""
    near = {b: Window.orderBy("length").rangeBetween(-b, b) for b in reach}  # one row a length
    means = {f"_m{b}": (F.sum("n").over(w) - F.col("n")) / (2 * b) for b, w in near.items()}
    others = F.array(*(F.struct(F.lit(b).alias("reach"), F.col(f"_m{b}").alias("mean")) for b in near))
    each = counts.select("length", "n").withColumns(means).select("length", "n", F.explode(others).alias("o")).filter("o.mean > 0")
    return each.select("length", "o.reach", (F.col("n") / F.col("o.mean")).alias("ratio"))


def smoothed(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """key, groups array<struct<value, size>>: values along positions while they stay within a tenth of their group's first."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col(value).cast("long").alias("v")))), lambda x: x["v"])

    def step(groups: Column, y: Column) -> Column:
        last = F.element_at(groups, -1)
        within = y.between(last["value"] * 0.9, last["value"] * 1.1)
        grown = F.concat(F.slice(groups, 1, F.size(groups) - 1), F.array(F.struct(last["value"].alias("value"), (last["size"] + 1).alias("size"))))
        return F.when((F.size(groups) > 0) & within, grown).otherwise(F.concat(groups, F.array(F.struct(y.alias("value"), F.lit(1).alias("size")))))

    start = F.array().cast("array<struct<value: bigint, size: int>>")
    return rows.groupBy(*key).agg(F.aggregate(ordered, start, lambda g, y: F.when(F.size(g) == 0, F.array(F.struct(y.alias("value"), F.lit(1).alias("size")))).otherwise(step(g, y))).alias("groups"))


def dropoff(rows: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """`rows` with smooth: each value at least half its neighbour's, forwards and then backwards.

    In logarithms, so that long series don't overflow: the running maximum of log2 v_j + j, less i. Values must not be negative.
    """
    up = Window.partitionBy(*key).orderBy(order)
    placed = rows.withColumn("_i", F.row_number().over(up).cast("double"))
    log = F.when(F.col(value) > 0, F.log2(F.col(value).cast("double")))
    forward = placed.withColumn("_f", F.max(log + F.col("_i")).over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_i"))
    down = Window.partitionBy(*key).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    both = forward.withColumn("_g", F.max(F.col("_f") - F.col("_i")).over(down) + F.col("_i"))
    return both.withColumn("smooth", F.coalesce(F.pow(F.lit(2.0), F.col("_g")), F.lit(0.0))).drop("_i", "_f", "_g")


def combined_regions(rows: DataFrame) -> DataFrame:
    """pos, region of `rows(region, ord, start, end, is_amino)`: the first region of a position, or a later amino region past the overlap's middle."""
    before = F.coalesce(F.lag("end").over(Window.orderBy("ord")), F.lit(0))  # one row a region
    middle = F.greatest(((before - F.col("start") + 1) / 2).cast("int"), F.lit(0))
    each = rows.withColumn("_middle", middle).select("region", "ord", "is_amino", F.posexplode(F.sequence("start", "end")).alias("_k", "pos"), "_middle")
    first = Window.partitionBy("pos")
    ranked = each.withColumn("_first", F.min("ord").over(first))
    eligible = ranked.filter((F.col("ord") == F.col("_first")) | (F.col("is_amino") & (F.col("_k") >= F.col("_middle"))))
    return eligible.groupBy("pos").agg(F.max(F.struct("ord", "region"))["region"].alias("region"))
