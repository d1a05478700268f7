"""Counts by position: bases, codons, aminos, reads, and consensus from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import seq as sequences
from readloom.functions.tables import CUTOFFS, codon_table, mixture_table

BASES = ["A", "C", "G", "T", "N", "-"]
COUNTED = ["A", "C", "T", "G", "-"]


#: Letters that are counted together before they are parted.
STRETCH = 4


def position_bases(aligned: DataFrame) -> DataFrame:
    """refname, pos (from 1), base, n of `aligned(refname, off, seq, cnt)`: the pileup in long form. n marks a gap, not a base.

    Stretches of STRETCH letters are counted by place first, so a row a stretch instead of one a base goes to the first sum.
    """
    begins = F.sequence(F.lit(0), F.length("seq") - 1, F.lit(STRETCH))
    cut = aligned.filter(F.length("seq") > 0).select("refname", "off", "cnt", "seq", F.explode(begins).alias("i"))
    stretch = F.substring(F.col("seq"), F.col("i") + 1, F.lit(STRETCH))
    counted = cut.groupBy("refname", (F.col("off") + F.col("i")).cast("long").alias("at"), stretch.alias("letters")).agg(F.sum("cnt").alias("n"))
    each = counted.select("refname", "at", "n", F.posexplode(F.split("letters", "")).alias("i", "base")).filter("base NOT IN ('n', '')")
    return each.groupBy("refname", (F.col("at") + F.col("i") + 1).alias("pos"), "base").agg(F.sum("n").cast("long").alias("n"))


def pileup(long: DataFrame) -> DataFrame:
    """refname, pos, A, C, G, T, N, del, coverage (of bases and deletions)."""
    wide = long.groupBy("refname", "pos").pivot("base", BASES).agg(F.sum("n")).fillna(0).withColumnRenamed("-", "del")
    return wide.withColumn("coverage", F.col("A") + F.col("C") + F.col("G") + F.col("T") + F.col("del"))


def consensus_bases(long: DataFrame, cutoffs: tuple[str, ...] = CUTOFFS, discard_deletions: bool = False) -> DataFrame:
    """refname, pos, cutoff, coverage, base: the mixture of bases with a share of the coverage (MAX: the most common and its ties).

    Small letters where a deletion is in the mixture; '-' (or '') for nothing else, N where there are no counted bases.
    """
    of_pos = Window.partitionBy("refname", "pos")
    counted = F.col("base").isin(COUNTED)
    whole = long.withColumns({"coverage": F.coalesce(F.sum(F.when(counted, F.col("n"))).over(of_pos), F.lit(0)), "most": F.max(F.when(counted, F.col("n"))).over(of_pos)})
    crossed = whole.withColumn("cutoff", F.explode(F.array(*map(F.lit, cutoffs))))
    least = F.when(F.col("cutoff") == "MAX", F.col("most").cast("double")).otherwise(F.col("coverage") * F.expr("try_cast(cutoff AS double)"))
    kept = counted & (F.col("n") >= least)
    mixed = crossed.groupBy("refname", "pos", "cutoff", "coverage").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(kept & (F.col("base") != "-"), F.col("base")))), "").alias("bases"),
        F.coalesce(F.bool_or(kept & (F.col("base") == "-")), F.lit(False)).alias("deleted"),
    )
    coded = mixed.join(F.broadcast(mixture_table(long.sparkSession)), "bases", "left")
    base = F.coalesce("code", F.when(F.col("deleted"), "" if discard_deletions else "-").otherwise("N"))
    return coded.select("refname", "pos", "cutoff", "coverage", F.when(F.col("deleted"), F.lower(base)).otherwise(base).alias("base"))


def consensus_sequences(bases: DataFrame, min_coverage: int = 100) -> DataFrame:
    """refname, cutoff, seed_offset, sequence: x below the coverage once begun, x at the end stripped."""
    text = F.when(F.col("coverage") < min_coverage, "x").otherwise(F.col("base"))
    ordered = bases.groupBy("refname", "cutoff").agg(F.array_sort(F.collect_list(F.struct("pos", text.alias("b")))).alias("all"))
    first = F.array_position(F.transform("all", lambda x: (x["b"] != "x") & (x["b"] != "")), F.lit(True)).cast("int")
    begun = ordered.withColumn("first", first).filter("first > 0")
    body = F.array_join(F.transform(F.slice("all", F.col("first"), F.size("all")), lambda x: x["b"]), "")
    return begun.select("refname", "cutoff", (F.element_at("all", F.col("first"))["pos"] - 1).alias("seed_offset"), F.regexp_replace(body, "x+$", "").alias("sequence"))


def codon_counts(aligned: DataFrame) -> DataFrame:
    """refname, frame (0, 1, 2), codon_idx, codon, n: reads padded with spaces to the codons of each frame.

    A codon of a frame is a window of three letters at some place, so windows are counted by place, once for all frames; words
    that hold STRETCH windows are counted before they are parted.
    """
    start = F.col("off").cast("long") - 2  # the first window that holds a letter
    begins = F.sequence(F.lit(0), F.length("seq") + 1, F.lit(STRETCH))
    padded = F.concat(F.lit("  "), "seq", F.lit("  ")).alias("padded")
    cut = aligned.filter(F.length("seq") > 0).select("refname", start.alias("start"), "cnt", padded, F.explode(begins).alias("i"))
    word = F.substring(F.col("padded"), F.col("i") + 1, F.lit(STRETCH + 2))
    words = cut.groupBy("refname", (F.col("start") + F.col("i")).alias("begin"), word.alias("word")).agg(F.sum("cnt").alias("n"))
    each = words.select("refname", "begin", "word", "n", F.explode(F.sequence(F.lit(0), F.length("word") - 3)).alias("k"))
    counted = each.groupBy("refname", (F.col("begin") + F.col("k")).alias("at"), F.substring(F.col("word"), F.col("k") + 1, F.lit(3)).alias("codon")).agg(F.sum("n").cast("long").alias("n"))
    frame = F.pmod(-F.col("at"), F.lit(3)).cast("int")
    return counted.select("refname", frame.alias("frame"), F.expr("CAST((at + pmod(-at, 3)) / 3 AS BIGINT)").alias("codon_idx"), "codon", "n")


def amino_counts(codons: DataFrame) -> DataFrame:
    """refname, frame, codon_idx, amino, n, and rows of kind low_quality, del, partial instead of an amino.

    Codons with a space or n tell nothing; those with N are of low quality.
    """
    c = F.col("codon")
    kind = F.when(c.contains("N"), "low_quality").when(c == "---", "del").when(c.contains("-"), "partial").when(c.rlike("[ n]"), None).otherwise("amino")
    named = codons.withColumn("kind", kind).filter("kind IS NOT NULL").join(F.broadcast(codon_table(codons.sparkSession)), "codon", "left")
    amino = F.when(F.col("kind") == "amino", F.coalesce("amino", F.lit("?"))).otherwise(F.col("kind"))
    return named.groupBy("refname", "frame", "codon_idx", amino.alias("amino")).agg(F.sum("n").alias("n"))


def combined(first: DataFrame, second: DataFrame, key: list[str], index: str, counts: list[str]) -> DataFrame:
    """Counters of two sources added; an index on which they differ becomes null."""
    both = first.unionByName(second)
    return both.groupBy(*key).agg(F.when(F.count_distinct(index) == 1, F.max(index)).alias(index), *(F.sum(c).alias(c) for c in counts))


def overlaps(own: DataFrame, other: DataFrame) -> DataFrame:
    """refname, codon_idx, v3_overlap: the other source's most counted base of the three, for codons that both have."""
    wide = pileup(other).select("refname", F.floor((F.col("pos") - 1) / 3).alias("codon_idx"), (F.col("A") + F.col("C") + F.col("G") + F.col("T")).alias("n"))
    codons = own.select("refname", F.floor((F.col("pos") - 1) / 3).alias("codon_idx")).distinct()
    return wide.groupBy("refname", "codon_idx").agg(F.max("n").alias("v3_overlap")).join(codons, ["refname", "codon_idx"], "left_semi")


def majority_bases(long: DataFrame) -> DataFrame:
    """refname, sequence: the most counted of A, C, G, T at each position (the first of them on ties), N where there are none."""
    best = long.filter(F.col("base").isin("A", "C", "G", "T")).groupBy("refname", "pos").agg(F.min(F.struct((-F.col("n")).alias("n"), "base"))["base"].alias("b"))
    spans = best.groupBy("refname").agg(F.max("pos").alias("last"))
    dense = spans.select("refname", F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("pos"))
    filled = dense.join(best, ["refname", "pos"], "left").fillna("N", ["b"])
    ordered = F.array_sort(F.collect_list(F.struct("pos", "b")))
    return filled.groupBy("refname").agg(F.array_join(F.transform(ordered, lambda x: x["b"]), "").alias("sequence"))


def read_counts(reads: DataFrame, key: list[str]) -> DataFrame:
    return reads.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


def canonical_counts(reads: DataFrame) -> DataFrame:
    """len, canonical, n over both mates."""
    canonical = sequences.canonical("seq")
    return reads.groupBy(F.length("seq").alias("len"), canonical.alias("canonical")).agg(F.count(F.lit(1)).alias("n"))


def top_counts(counts: DataFrame, least: int) -> DataFrame:
    """Reads with `least` counts or more, and one row (seq null) for the sum of the others, if any."""
    top = counts.filter(F.col("n") >= least).select("seq", "n")
    rest = counts.filter(F.col("n") < least).agg(F.sum("n").alias("n")).filter("n IS NOT NULL").select(F.lit(None).cast("string").alias("seq"), "n")
    return top.unionByName(rest)


def ranked(rows: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """`rows` with rank, from 0, within the key in input order."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)


def shares(long: DataFrame) -> DataFrame:
    """refname (null: all contigs together), pos, base, share in percent; shares that round to 0.00 are hidden, totals of one contig too."""
    sets = long.groupingSets([["refname", "pos", "base"], ["pos", "base"]], "refname", "pos", "base").agg(F.sum("n").alias("n"), F.grouping("refname").alias("all"), F.count_distinct("refname").alias("_c"))
    of = Window.partitionBy("all", "refname", "pos")
    contigs = long.groupBy("pos").agg(F.count_distinct("refname").alias("contigs"))
    share = F.round(100 * F.col("n") / F.sum("n").over(of), 2)
    return sets.withColumn("share", share).join(contigs, "pos").filter("share > 0 AND (all = 0 OR contigs > 1)").select("refname", "pos", "base", "share")
