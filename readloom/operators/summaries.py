"""Lookups, insertions, region summaries, search hits and mutations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators import scans


def nearest(rows: DataFrame, value: str, table: DataFrame, cells: int = 100) -> DataFrame:
    """`rows` with fpr: that of the entry of `table(score, fpr)` nearest to the value, the lower one of two; null outside 0 to 1.

    Entries become intervals that end half-way to their neighbours, which rows meet in cells of the range.
    """
    order = Window.orderBy("score")  # a fixed lookup table
    low, high = (F.lag("score").over(order) + F.col("score")) / 2, (F.lead("score").over(order) + F.col("score")) / 2
    bounded = table.select("fpr", F.coalesce(low, F.lit(-1.0)).alias("_low"), F.coalesce(high, F.lit(2.0)).alias("_high"))
    cut = bounded.withColumn("_cell", F.explode(F.sequence(F.floor(F.greatest("_low", F.lit(0.0)) * cells), F.floor(F.least("_high", F.lit(1.0)) * cells))))
    found = rows.withColumn("_cell", F.when(F.col(value).between(0, 1), F.floor(F.col(value) * cells)))
    joined = found.join(cut, (found["_cell"] == cut["_cell"]) & (F.col(value) > F.col("_low")) & (F.col(value) <= F.col("_high")), "left")
    return joined.select(*rows.columns, "fpr")


RHO, A, B = 1.33153, -2.31191, 0.244784  # fixed values of the logistic


def matrix_score(candidates: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """key, score of `candidates(key, pos, amino)`: the sum of weights over positions, of each combination of ambiguous ones, after a logistic, averaged."""
    weighed = candidates.join(weights, ["pos", "amino"], "left").fillna(0.0, ["weight"])
    per = weighed.groupBy(key, "pos").agg(F.collect_list("weight").alias("w"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "w"))), lambda x: x["w"])
    sums = F.aggregate(ordered, F.array(F.lit(0.0)), lambda a, w: F.flatten(F.transform(a, lambda s: F.transform(w, lambda x: s + x))))
    scores = F.transform(sums, lambda s: 1 / (1 + F.exp((RHO - s) * A + B - 0.5)))
    whole = per.groupBy(key).agg(scores.alias("s"))
    return whole.select(key, (F.aggregate("s", F.lit(0.0), lambda a, x: a + x) / F.size("s")).alias("score"))


def insertion_counts(inserts: DataFrame, coverage: DataFrame) -> DataFrame:
    """rname, ref_pos, i, base, n of `inserts(qname, mate, rname, ref_pos, insert)`: a read's first insertion at a position counts; missing coverage is '-'."""
    first = inserts.groupBy("rname", "ref_pos", "qname").agg(F.min(F.struct("mate", "insert"))["insert"].alias("insert"))
    alike = first.groupBy("rname", "ref_pos", "insert").agg(F.count(F.lit(1)).alias("n"))
    each = alike.select("rname", "ref_pos", "n", F.posexplode(F.filter(F.split("insert", ""), lambda c: c != "")).alias("i", "base"))
    counted = each.groupBy("rname", "ref_pos", "i", "base").agg(F.sum("n").alias("n"))
    rest = counted.groupBy("rname", "ref_pos", "i").agg(F.sum("n").alias("have")).join(coverage, ["rname", "ref_pos"])
    missing = rest.filter("coverage > have").select("rname", "ref_pos", "i", F.lit("-").alias("base"), (F.col("coverage") - F.col("have")).alias("n"))
    return counted.unionByName(missing)


def inserted_slices(aligned: DataFrame, left: int, right: int) -> DataFrame:
    """refname, slice, n: what reads have in [left, right), whole slices without n and dashes."""
    start = F.lit(left) - F.col("off")
    cut = aligned.filter((start >= 0) & (F.col("off") + F.length("seq") >= right)).withColumn("slice", F.substring(F.col("seq"), (start + 1).cast("int"), F.lit(right - left)))
    return cut.filter(~F.col("slice").rlike("[n-]")).groupBy("refname", "slice").agg(F.sum("cnt").cast("long").alias("n"))


def agreement(long: DataFrame, candidates: DataFrame) -> DataFrame:
    """dest, refname, agree, disagree: counts of bases that are, and aren't, those of each candidate `candidates(dest, pos, expected)`, a configured few."""
    joined = long.filter(F.col("base").isin("A", "C", "G", "T")).join(candidates, "pos")
    same = F.col("base") == F.col("expected")
    return joined.groupBy("dest", "refname").agg(F.sum(F.when(same, F.col("n")).otherwise(0)).alias("agree"), F.sum(F.when(~same, F.col("n")).otherwise(0)).alias("disagree"))


def stretch_lengths(sequences: DataFrame, column: str) -> DataFrame:
    """length, n of the stretches between x of sequences."""
    parts = F.explode(F.filter(F.split(column, "x"), lambda s: s != ""))
    return sequences.select(parts.alias("s")).groupBy(F.length("s").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def region_concordance(bases: DataFrame, regions: DataFrame, least: int = 100) -> DataFrame:
    """refname, region, pct_concordance, pct_covered of `bases(refname, pos, coverage, base, expected)` in `regions(region, start, end)`.

    Covered is strictly more than `least`; a consensus of '-' that isn't expected isn't covered. Regions are configured.
    """
    cut = regions.select("region", "start", "end", F.explode(F.sequence("start", "end")).alias("pos"))
    joined = bases.join(cut, "pos")
    covered, same = F.col("coverage") > least, F.col("base") == F.col("expected")
    good, seen = F.count_if(covered & same), F.count_if(covered & (same | (F.col("base") != "-")))
    size = F.max(F.col("end") - F.col("start") + 1)
    return joined.groupBy("refname", "region").agg(F.when(seen > 0, 100 * good / F.when(seen > 0, seen)).otherwise(0.0).alias("pct_concordance"), (100 * seen / size).alias("pct_covered"))


def region_failures(expected: DataFrame, reported: DataFrame) -> DataFrame:
    """seed, region of expected regions of seeds of which no region was reported."""
    return expected.join(reported.select("seed").distinct(), "seed", "left_anti")


def covered_region_names(rows: DataFrame, starred: list[str]) -> DataFrame:
    """sample, seed, name: regions joined by ~ in order, those of resistance with a star."""
    name = F.concat("region", F.when(F.col("region").isin(starred), "*").otherwise(""))
    return rows.groupBy("sample", "seed").agg(F.array_join(F.array_sort(F.collect_set(name)), "~").alias("name"))


def best_hits(hits: DataFrame, key: str, order: list[str]) -> DataFrame:
    """key, ref, match of `hits(key, ref, score, share, start, end)`: the best score's, the last of equals; negative on the other strand."""
    last = F.max(F.struct("score", *order, "ref", (F.col("share") * F.when(F.col("start") <= F.col("end"), 1).otherwise(-1)).alias("match")))
    return hits.groupBy(key).agg(last.alias("m")).select(key, F.col("m.ref").alias("ref"), F.col("m.match").alias("match"))


def group_references(hits: DataFrame, groups: DataFrame) -> DataFrame:
    """grp, ref: of each seed group the reference with the largest sum of scores, the first by name of equals."""
    total = hits.join(groups, "ref").groupBy("grp", "ref").agg(F.sum("score").alias("total"))
    return total.groupBy("grp").agg(F.min(F.struct((-F.col("total")).alias("t"), "ref"))["ref"].alias("ref"))


def nucleotide_mutations(wide: DataFrame, wild: Column, least: float = 0.05) -> DataFrame:
    """refname, pos, wt, var, prevalence of bases other than the wild type with a share of the coverage."""
    each = wide.filter("coverage > 0").withColumn("wt", wild).unpivot(["refname", "pos", "wt", "coverage"], ["A", "C", "G", "T"], "var", "n")
    return each.withColumn("prevalence", F.col("n") / F.col("coverage")).filter((F.col("var") != F.col("wt")) & (F.col("prevalence") >= least)).select("refname", "pos", "wt", "var", "prevalence")


def sample_summary(rows: DataFrame, key: str, min_valid: int, min_percent: float) -> DataFrame:
    """key, mapped, valid, x4, x4_pct, final, valid_pct of `rows(key, count, valid, x4)`: X4 from 2 percent on; no call with too few valid."""
    per = rows.groupBy(key).agg(F.sum("count").alias("mapped"), F.sum(F.when(F.col("valid"), F.col("count")).otherwise(0)).alias("valid"), F.sum(F.when(F.col("valid") & F.col("x4"), F.col("count")).otherwise(0)).alias("x4"))
    none = F.col("valid") == 0
    some = F.when(~none, F.col("valid"))
    x4, share = 100.0 * F.col("x4") / some, 100.0 * F.col("valid") / F.col("mapped")
    few = none | (F.col("valid") < min_valid) | (share < min_percent)
    return per.select(
        key, "mapped", "valid", "x4", F.when(none, "").otherwise(F.format_string("%.2f", x4)).alias("x4_pct"),
        F.when(few, "").when(x4 >= 2.0, "X4").otherwise("R5").alias("final"), F.format_string("%.2f", F.when(none, 0.0).otherwise(share)).alias("valid_pct"),
    )


def interval_coverage(spans: DataFrame) -> DataFrame:
    """ref, pos, coverage where it changes: a running sum of begins and ends, so no interval is exploded."""
    events = spans.select("ref", F.explode(F.array(F.struct(F.col("r_st").alias("pos"), F.lit(1).alias("d")), F.struct((F.col("r_ei") + 1).alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    changes = events.groupBy("ref", F.col("e.pos").alias("pos")).agg(F.sum("e.d").alias("d"))
    return scans.running(scans.laid(changes, ["ref"], ["pos"]), ["ref"], ["pos"], {"coverage": ("sum", F.col("d"))}).select("ref", "pos", "coverage")


def genome_coverage(tokens: DataFrame, key: str = "rname", weight: str | None = None) -> DataFrame:
    """key, ref_pos, link (M matched, D deleted, U unmatched: clipped), coverage, dels; insertions have the position before them and link I.

    `weight` is a column that tells how many reads have a token (none: one). Equal stretches are counted before they become positions.
    """
    first, size = F.col("pos") + F.col("r0"), F.col("len")
    start = F.when(F.col("op") == "I", first - 1).when((F.col("op") == "S") & (F.col("q0") == 0), first - size).otherwise(first).cast("long")
    size = F.when(F.col("op") == "I", 1).otherwise(size)
    link = F.when(F.col("op") == "S", "U").otherwise(F.col("op"))
    spans = tokens.filter("op = 'I' OR op IN ('M', 'D', 'S') AND len > 0").groupBy(key, start.alias("start"), size.alias("size"), link.alias("link")).agg(F.sum(F.col(weight) if weight else F.lit(1)).alias("n"))
    rows = spans.select(key, "link", "n", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("ref_pos"))
    per = rows.groupBy(key, "ref_pos", "link").agg(F.sum("n").alias("n"))
    count = lambda *links: F.sum(F.when(F.col("link").isin(*links), F.col("n")).otherwise(0)).over(Window.partitionBy(key, "ref_pos"))
    return per.select(key, "ref_pos", "link", "n", count("M", "D").alias("coverage"), count("D").alias("dels"))


def compared_positions(pairs: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """kind, n of the columns of two aligned sequences: match, deletion, addition, mismatch."""
    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    each = pairs.select(key, F.explode(F.zip_with(letters(first), letters(second), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("x"))
    a, b = F.col("x.a"), F.col("x.b")
    kind = F.when(a == b, "match").when(F.coalesce(b, F.lit("-")) == "-", "deletion").when(F.coalesce(a, F.lit("-")) == "-", "addition").otherwise("mismatch")
    return each.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
