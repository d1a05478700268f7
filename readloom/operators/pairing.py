"""Read pairs: mates side by side, merged bases, insertions, failures, clips, movement between mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import cigar
from readloom.functions.bind import bind

QUALITY_CUTOFF, QUALITY_DELTA, MOST_N = 15, 5, 0.5


def pair_mates(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """A row for each `key`: its first row by `order` as struct r1, its second as r2 (null for singles), and n. One shuffle."""
    item = F.struct(*order, *(c for c in columns if c not in order))
    both = rows.groupBy(key).agg(F.min(item).alias("r1"), F.max(item).alias("_last"), F.count(F.lit(1)).alias("n"))
    return both.select(key, "r1", F.when(F.col("n") > 1, F.col("_last")).alias("r2"), "n")


def join_mates(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows of `first` with their mates; a read without a mate is an error."""
    other = second.select(key, *(F.col(c).alias(f"{c}2") for c in second.columns if c != key), F.lit(True).alias("_there"))
    joined = first.join(other, key, "left")
    checked = F.when(F.col("_there"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no mate of "), F.col(key).cast("string"))).cast(first.schema[key].dataType))
    return joined.withColumn(key, checked).drop("_there")


def pair_by_index(first: DataFrame, second: DataFrame, index: str, strict: bool = True) -> DataFrame:
    """Records of two files with equal index; `strict`: different counts are an error."""
    a = first.select(F.col(index), F.struct(*first.columns).alias("r1"))
    b = second.select(F.col(index), F.struct(*second.columns).alias("r2"))
    if not strict:
        return a.join(b, index)
    whole = a.join(b, index, "full")
    fine = F.col("r1").isNotNull() & F.col("r2").isNotNull()
    return whole.filter(F.when(fine, True).otherwise(F.raise_error(F.lit("different numbers of records")).cast("boolean")))


def merged(seq1: Column, qual1: Column, seq2: Column, qual2: Column, cutoff: int = QUALITY_CUTOFF, delta: int = QUALITY_DELTA) -> Column:
    """One string of two mates laid on the reference; the shorter counts as the first.

    Equal bases stay. Of different ones the better by `delta` stays, else N. Where neither exceeds the cutoff, a base is N. Past
    the first's end the second stands, after a gap of n up to its first base. A dash never becomes N.
    """
    swap = F.length(seq1) > F.length(seq2)
    pick = lambda a, b: F.when(swap, a).otherwise(b)
    letters = lambda c: F.split(c, "")
    gap = F.length(pick(seq1, seq2)) - F.length(F.ltrim(pick(seq1, seq2), F.lit("-")))
    # the shorter one's arrays end in nulls
    columns = F.arrays_zip(letters(pick(seq2, seq1)).alias("a"), letters(pick(qual2, qual1)).alias("qa"), letters(pick(seq1, seq2)).alias("b"), letters(pick(qual1, qual2)).alias("qb"))

    def base(x: Column, i: Column) -> Column:
        a, b, past = x["a"], x["b"], x["a"].isNull()
        qa, qb = F.coalesce(cigar.phred(x["qa"]), F.lit(-33)), cigar.phred(x["qb"])
        differ = past | (a != b)
        kept = F.when(past | (differ & (qb - qa >= delta)), b).otherwise(a)
        bad = (kept != "-") & ((differ & (F.abs(qb - qa) < delta)) | (F.greatest(qa, qb) <= cutoff))
        return F.when(past & (i < gap), "n").when(bad, "N").otherwise(kept)

    return F.array_join(F.transform(columns, base), "")


def merge_pairs(sam: DataFrame) -> DataFrame:
    """qname, rname, cause of failure (null: none) and merged (null for failed pairs) of `sam(qname, flag, rname, pos, cigar, seq, qual, mate)`.

    Causes, the first that holds: unmatched, badCigar, 2refs, manyNs.
    """
    columns = ["mate", "flag", "rname", "pos", "cigar", "seq", "qual"]
    pairs = pair_mates(sam, "qname", ["mate"], columns)
    a, b = F.col("r1"), F.col("r2")
    cause = F.when(b.isNull(), "unmatched").when((a["cigar"] == "*") | (b["cigar"] == "*"), "badCigar").when(a["rname"] != b["rname"], "2refs")
    laid = F.struct(*(cigar.aligned_strings(r["seq"], r["qual"], r["pos"], r["cigar"]).alias(n) for n, r in (("x", a), ("y", b))))
    text = bind(laid, lambda v: merged(v["x"]["seq"], v["x"]["qual"], v["y"]["seq"], v["y"]["qual"]))
    ns = lambda m: F.length(m) - F.length(F.translate(m, "N", ""))
    judged = bind(text, lambda m: F.struct(m.alias("text"), (ns(m) / F.length(F.trim(m, F.lit("-"))) > MOST_N).alias("many")))
    # a generator: else the optimizer would write the merge out at each use of it
    both = pairs.select("qname", a["rname"].alias("rname"), cause.alias("cause"), F.explode(F.array(F.when(cause.isNull(), judged))).alias("m"))
    failed = F.coalesce("cause", F.when(F.col("m.many"), "manyNs"))
    return both.select("qname", "rname", failed.alias("cause"), F.when(failed.isNull(), F.col("m.text")).alias("merged"))


def single(seq: Column, qual: Column, cutoff: int = QUALITY_CUTOFF) -> Column:
    """One string of a read without a mate, as `merged` has it: n before its first base, N where its quality doesn't exceed the cutoff."""
    gap = F.length(seq) - F.length(F.ltrim(seq, F.lit("-")))
    columns = F.arrays_zip(F.split(seq, "").alias("b"), F.split(qual, "").alias("q"))
    base = lambda x, i: F.when(i < gap, "n").when((x["b"] != "-") & (cigar.phred(x["q"]) <= cutoff), "N").otherwise(x["b"])
    return F.array_join(F.transform(columns, base), "")


def mapped_texts(sam: DataFrame) -> DataFrame:
    """qname, rname, text of pairs on one reference: their mapped mates merged, or the one that is mapped. `sam` as of `merge_pairs`."""
    columns = ["mate", "flag", "rname", "pos", "cigar", "seq", "qual"]
    pairs = pair_mates(sam, "qname", ["mate"], columns)
    a, b = F.col("r1"), F.col("r2")
    mapped = lambda r: r.isNotNull() & ~cigar.is_unmapped(r["flag"])
    kept = pairs.filter(b.isNull() | (a["rname"] == b["rname"])).select("qname", a["rname"].alias("rname"), F.when(mapped(a), a).otherwise(b).alias("x"), F.when(mapped(a) & mapped(b), b).alias("y"))
    laid = lambda r: cigar.aligned_strings(r["seq"], r["qual"], r["pos"], r["cigar"])
    one = bind(laid(F.col("x")), lambda v: single(v["seq"], v["qual"]))
    two = bind(F.struct(laid(F.col("x")).alias("x"), laid(F.col("y")).alias("y")), lambda v: merged(v["x"]["seq"], v["x"]["qual"], v["y"]["seq"], v["y"]["qual"]))
    return kept.filter(mapped(F.col("x"))).select("qname", "rname", F.when(F.col("y").isNull(), one).otherwise(two).alias("text"))


def merge_insertions(inserts: DataFrame, cutoff: int = QUALITY_CUTOFF) -> DataFrame:
    """qname, ref_pos, merged of `inserts(qname, mate, ref_pos, insert, insert_qual)`; one counts if its worst quality exceeds the cutoff."""
    worst = F.array_min(F.transform(F.filter(F.split("insert_qual", ""), lambda c: c != ""), cigar.phred))
    good = inserts.filter(worst > cutoff)
    first, second = (good.filter(F.col("mate") == m).select("qname", "ref_pos", F.col("insert").alias(f"s{m}"), F.col("insert_qual").alias(f"q{m}")) for m in (1, 2))
    both = first.join(second, ["qname", "ref_pos"], "full")
    one = F.coalesce("s1", "s2")
    return both.select("qname", "ref_pos", F.when(F.col("s1").isNull() | F.col("s2").isNull(), one).otherwise(merged(F.col("s1"), F.col("q1"), F.col("s2"), F.col("q2"), cutoff)).alias("merged"))


def clip_counts(sam: DataFrame) -> DataFrame:
    """rname, ref_pos, n: usable pairs (two reads with cigars on one reference) in which a mate is clipped at the position and neither is mapped there.

    Pairs whose mates have the same places, cigars and lengths are counted first; of each such pair the clipped positions lose the
    mapped ones within a row, and only what is left is exploded.
    """
    read = F.struct("pos", "cigar", F.length("seq").alias("size"))
    pairs = sam.groupBy("qname").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("cigar") == "*").alias("_bare"), F.min("rname").alias("rname"), F.max("rname").alias("_last"), F.array_sort(F.collect_list(read)).alias("reads"))
    alike = pairs.filter("_n = 2 AND _bare = 0 AND rname = _last").groupBy("rname", "reads").agg(F.count(F.lit(1)).alias("n"))
    none = F.array().cast("array<bigint>")

    def held(op: str) -> Column:
        def places(r: Column) -> Column:
            def own(t: Column) -> Column:
                start = r["pos"] + t["r0"] - F.when((t["op"] == "S") & (t["q0"] == 0), t["len"]).otherwise(0)
                return F.sequence(start.cast("long"), (start + t["len"] - 1).cast("long"))

            tokens = F.filter(cigar.token_array(r["cigar"]), lambda t: (t["op"] == op) & (t["len"] > 0))
            return F.when(cigar.fits(r["cigar"], r["size"]), F.flatten(F.transform(tokens, own))).otherwise(none)

        return F.flatten(F.transform("reads", places))

    left = alike.select("rname", "n", F.explode(F.array_except(held("S"), held("M"))).alias("ref_pos"))
    return left.groupBy("rname", "ref_pos").agg(F.sum("n").alias("n"))


def resolve_mixed_references(sam: DataFrame) -> DataFrame:
    """qname, rname, mapq, score of pairs whose mapped mates are on two references: by higher MAPQ (a number), then by higher
    alignment score (none is least), else the first mate. One shuffle."""
    item = F.struct("mapq", "score", (-F.col("mate")).alias("m"), "rname")
    mapped = sam.filter(~cigar.is_unmapped(F.col("flag"))).groupBy("qname").agg(F.max(item).alias("best"), F.min("rname").alias("low"), F.max("rname").alias("high"))
    return mapped.filter("low < high").select("qname", "best.rname", "best.mapq", "best.score")


def read_movement(before: DataFrame, after: DataFrame, width: int = 100, least_share: float = 0.1) -> DataFrame:
    """source, target, n: reads by bins of `rname:pos // width` in two mappings (unmapped: '*'); targets below a share of the source go."""
    binned = lambda d, name: d.select("qname", "mate", F.when(cigar.is_unmapped(F.col("flag")), "*").otherwise(F.concat("rname", F.lit(":"), F.floor(F.col("pos") / width).cast("string"))).alias(name))
    both = binned(before, "source").join(binned(after, "target"), ["qname", "mate"], "full").fillna("*", ["source", "target"])
    counted = both.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("source"))
    return counted.withColumn("_share", share).filter(F.col("_share") >= least_share).drop("_share")


def censored(reads: DataFrame, bad_cycles: DataFrame) -> DataFrame:
    """`reads(pair_id, mate, tile, seq, qual)` with N of quality # in bad cycles (of the second mate: negative ones) of its tile.

    A tile's bad cycles are few and joined as one array, so reads stay whole; only those letters are looked at.
    """
    per_tile = bad_cycles.groupBy("tile").agg(F.collect_set("cycle").alias("cycles"))
    joined = reads.join(per_tile, "tile", "left")
    sign = F.when(F.col("mate") == 1, 1).otherwise(-1)

    def mask(text: str, to: str) -> Column:
        at = lambda c: (c * sign).cast("int")
        one = lambda a, c: F.when(at(c).between(1, F.length(a)), F.overlay(a, F.lit(to), at(c), F.lit(1))).otherwise(a)
        return F.when(F.col("cycles").isNull(), F.col(text)).otherwise(F.aggregate("cycles", F.col(text), one))

    return joined.withColumns({"seq": mask("seq", "N"), "qual": mask("qual", "#")}).drop("cycles")


def cut_primers(reads: DataFrame, starts: DataFrame, ends: DataFrame) -> DataFrame:
    """`reads(pair_id, mate, seq)` cut by start_len and end_len, joined by read; pairs with an empty mate go."""
    key = ["pair_id", "mate"]
    joined = reads.join(starts, key, "left").join(ends, key, "left").fillna(0, ["start_len", "end_len"])
    length = F.greatest(F.length("seq") - F.col("start_len") - F.col("end_len"), F.lit(0))
    cut = joined.withColumn("seq", F.substring(F.col("seq"), F.col("start_len") + 1, length)).drop("start_len", "end_len")
    return cut.withColumn("_least", F.min(F.length("seq")).over(Window.partitionBy("pair_id"))).filter("_least > 0").drop("_least")


def kept_pairs(reads: DataFrame, key: str, keep: int, of: int) -> DataFrame:
    """A sample of pairs, whole: those whose key's hash modulo `of` is below `keep`."""
    return reads.filter(F.pmod(F.col(key), F.lit(of)) < keep)
