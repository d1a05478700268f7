"""Rule-based resistance calls as joins of amino tables with a normalised rule table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_COVERAGE, MIN_FRACTION = 100, 0.05


def coverage_check(coverage: DataFrame, windows: DataFrame, least: int = MIN_COVERAGE) -> DataFrame:
    """seed, reason of `coverage(seed, pos, coverage)` against `windows(seed, start, end)`; null reason: enough.

    The average is over the window's width; the end must be covered, the start only if it is the first position.
    """
    joined = windows.join(coverage, "seed", "left")
    inside = F.col("pos").between(F.col("start"), F.col("end"))
    at = lambda p: F.coalesce(F.max(F.when(F.col("pos") == F.col(p), F.col("coverage"))), F.lit(0))
    per = joined.groupBy("seed", "start", "end").agg((F.coalesce(F.sum(F.when(inside, F.col("coverage"))), F.lit(0)) / (F.max("end") - F.max("start") + 1)).alias("mean"), at("start").alias("first"), at("end").alias("last"))
    reason = F.when(F.col("mean") < least, "low average coverage").when(F.col("last") < least, "not enough high-coverage amino acids").when((F.col("start") == 1) & (F.col("first") < least), "not enough high-coverage amino acids")
    return per.select("seed", reason.alias("reason"))


def combined_samples(main: DataFrame, midi: DataFrame, start: int = 227, end: int = 336) -> DataFrame:
    """seed, pos, coverage, source: the second sample's from `start` on, unless up to `end` the first has more; the first alone only to `end`."""
    a = main.select("seed", "pos", F.col("coverage").alias("a"))
    b = midi.filter(F.col("pos") >= start).select("seed", "pos", F.col("coverage").alias("b"))
    both = a.join(b, ["seed", "pos"], "full")
    first = (F.col("pos") <= end) & (F.col("b").isNull() | (F.col("a") > F.col("b")))
    kept = both.filter(F.col("b").isNotNull() | first)
    return kept.select("seed", "pos", F.when(first, F.col("a")).otherwise(F.col("b")).alias("coverage"), F.when(first, "main").otherwise("midi").alias("source"))


def prevalent_aminos(aminos: DataFrame, fraction: float = MIN_FRACTION, least: int = MIN_COVERAGE) -> DataFrame:
    """seed, pos, amino, share of aminos with at least one read and the fraction of the coverage; no stop codons; none below the coverage."""
    total = F.sum("n").over(Window.partitionBy("seed", "pos"))
    shared = aminos.withColumn("coverage", total)
    kept = (F.col("n") >= F.greatest(F.lit(1.0), F.col("coverage") * fraction)) & (F.col("amino") != "*") & (F.col("coverage") >= least)
    return shared.filter(kept).select("seed", "pos", "amino", (F.col("n") / F.col("coverage")).alias("share"))


def padded_positions(prevalent: DataFrame, length: int) -> DataFrame:
    """seed, pos, aminos array: every position of 1 to `length`, empty where there is nothing."""
    sets = prevalent.groupBy("seed", "pos").agg(F.array_sort(F.collect_set("amino")).alias("aminos"))
    dense = prevalent.select("seed").distinct().select("seed", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(length).cast("long"))).alias("pos"))
    return dense.join(sets, ["seed", "pos"], "left").withColumn("aminos", F.coalesce("aminos", F.array().cast("array<string>")))


def needed_reports(positions: DataFrame, keys: DataFrame) -> DataFrame:
    """seed, complete: whether all key positions have aminos."""
    have = positions.filter(F.size("aminos") > 0).select("seed", "pos", F.lit(True).alias("_h"))
    wanted = positions.select("seed").distinct().join(F.broadcast(keys.select("pos").distinct()))  # a configured list
    return wanted.join(have, ["seed", "pos"], "left").groupBy("seed").agg(F.bool_and(F.coalesce("_h", F.lit(False))).alias("complete"))


def rule_scores(positions: DataFrame, rules: DataFrame) -> DataFrame:
    """seed, drug, score, flags, missing of `positions(seed, pos, aminos)` and `rules(drug, pos, amino set string, score, flag)`.

    A rule counts if its aminos meet the sample's; a position without aminos makes the call fail. Rules are a configured list.
    """
    joined = positions.join(rules, "pos")
    meets = F.size(F.array_intersect("aminos", F.filter(F.split("rule", ""), lambda x: x != ""))) > 0
    return joined.groupBy("seed", "drug").agg(
        F.coalesce(F.sum(F.when(meets, F.col("score"))), F.lit(0)).alias("score"),
        F.array_sort(F.collect_set(F.when(meets, F.col("flag")))).alias("flags"),
        F.bool_or(F.size("aminos") == 0).alias("missing"),
    )


def levels(scored: DataFrame, ranges: list[tuple[int, int, int]]) -> DataFrame:
    """`scored` with level: 0 for a missing position, of the score's range, or for a score of 0 what its flags say."""
    score = F.col("score")
    level: Column = F.lit(1)
    for low, high, value in ranges:
        level = F.when(score.between(low, high), value).otherwise(level)
    flagged = F.when(F.array_contains("flags", "Not available"), -1).when(F.array_contains("flags", "Not indicated"), 2).when(F.array_contains("flags", "Effect unknown"), 3)
    return scored.withColumn("level", F.when(F.col("missing"), 0).otherwise(F.when(score == 0, F.coalesce(flagged, level)).otherwise(level)))


def wild_type_pass(positions: DataFrame, wild: DataFrame, rules: DataFrame, ranges: list[tuple[int, int, int]]) -> DataFrame:
    """seed, drug, level: failed calls are tried again with wild-type aminos in the gaps; a second pass may only show resistance."""
    first = levels(rule_scores(positions, rules), ranges).select("seed", "drug", F.col("level").alias("one"))
    filled = positions.join(wild, "pos", "left").select("seed", "pos", F.when(F.size("aminos") == 0, F.array("wild")).otherwise(F.col("aminos")).alias("aminos"))
    second = levels(rule_scores(filled, rules), ranges).select("seed", "drug", F.col("level").alias("two"))
    level = F.when((F.col("one") == 0) & (F.col("two") > 1), F.col("two")).otherwise(F.col("one"))
    return first.join(second, ["seed", "drug"]).select("seed", "drug", level.alias("level"))


def region_consensus(positions: DataFrame) -> DataFrame:
    """seed, offset, consensus: '-' for nothing, one amino, or a mixture in brackets; without dashes at the ends."""
    text = F.when(F.size("aminos") == 0, "-").when(F.size("aminos") == 1, F.get("aminos", 0)).otherwise(F.concat(F.lit("["), F.array_join("aminos", ""), F.lit("]")))
    ordered = F.array_sort(F.collect_list(F.struct("pos", text.alias("t"))))
    whole = positions.groupBy("seed").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias("all"))
    return whole.select("seed", (F.length("all") - F.length(F.ltrim("all", F.lit("-")))).alias("offset"), F.trim(F.col("all"), F.lit("-")).alias("consensus"))


def rule_sets(genotypes: DataFrame, available: DataFrame, backup: dict[str, str]) -> DataFrame:
    """genotype, rules: those of the genotype, else of its backup, else 'Not available'."""
    pairs = genotypes.sparkSession.createDataFrame(list(backup.items()), "genotype string, backup string")
    exact, other = available.select("genotype", F.col("rules").alias("a")), available.select(F.col("genotype").alias("backup"), F.col("rules").alias("b"))
    joined = genotypes.join(exact, "genotype", "left").join(pairs, "genotype", "left").join(other, "backup", "left")
    return joined.select("genotype", F.coalesce("a", "b", F.lit("Not available")).alias("rules"))
