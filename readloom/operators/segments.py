"""Consensus for remapping, counts attached to reports, concordance of aligned segments, matches that don't collide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Letters that are counted together before they are parted, and positions of a block, each a bit of a number.
STRETCH, BLOCK = 4, 32


def letter_counts(stretches: DataFrame, key: str = "rname") -> DataFrame:
    """key, ref_pos, base, n of `stretches(key, start, letters)`: pieces of STRETCH letters are counted by place before they are parted."""
    cut = stretches.filter(F.length("letters") > 0).select(key, "start", "letters", F.explode(F.sequence(F.lit(0), F.length("letters") - 1, F.lit(STRETCH))).alias("i"))
    piece = F.substring(F.col("letters"), F.col("i") + 1, F.lit(STRETCH))
    counted = cut.groupBy(key, (F.col("start") + F.col("i")).alias("at"), piece.alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    each = counted.select(key, "at", "n", F.posexplode(F.split("piece", "")).alias("i", "base")).filter("base <> ''")
    return each.groupBy(key, (F.col("at") + F.col("i")).alias("ref_pos"), "base").agg(F.sum("n").alias("n"))


def merged_bases(texts: DataFrame, inserts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`bases` and `inserts` for `remap_tokens` of `texts(qname, rname, text)`, merged pairs laid on their references, and the merged
    `inserts(qname, ref_pos, merged)`: a pair counts once where its mates overlap. What is before a text's first base isn't there."""
    lead = F.length("text") - F.length(F.ltrim("text", F.lit("-")))
    begun = texts.select("rname", (lead + 1).cast("long").alias("start"), F.substring(F.col("text"), lead + 1, F.length("text")).alias("letters"))
    bases = letter_counts(begun).withColumnRenamed("ref_pos", "pos")
    held = texts.join(inserts, "qname").select("rname", F.col("ref_pos").alias("pos"), F.substring(F.col("text"), F.col("ref_pos").cast("int"), F.lit(1)).alias("base"), F.col("merged").alias("insert"))
    return bases, held.filter("base <> ''")


def remap_tokens(bases: DataFrame, inserts: DataFrame, key: str = "rname") -> DataFrame:
    """key, pos, token, n of `bases(key, pos, base)` and `inserts(key, pos, base, insert)`, a row a read; bases may be counted, with n.

    An insertion of whole codons joins the base before it as one token, and takes the place of that base. n, a gap, isn't counted.
    """
    whole = inserts.filter("length(insert) % 3 = 0 AND base NOT IN ('n', 'N', '-')")
    plain = bases.filter("base <> 'n'").select(key, "pos", F.col("base").alias("token"), (F.col("n") if "n" in bases.columns else F.lit(1)).cast("long").alias("n"))
    moved = F.array(F.struct(F.concat("base", "insert").alias("token"), F.lit(1).alias("n")), F.struct(F.col("base").alias("token"), F.lit(-1).alias("n")))
    longer = whole.select(key, "pos", F.explode(moved).alias("t")).select(key, "pos", "t.token", F.col("t.n").cast("long").alias("n"))
    return plain.unionByName(longer).groupBy(key, "pos", "token").agg(F.sum("n").alias("n")).filter("n > 0")


def remap_consensus(tokens: DataFrame, seeds: DataFrame | None = None, key: str = "rname") -> DataFrame:
    """key, sequence: the most counted token of each position from 1, the least by letters of equals.

    N and dashes count only where nothing else is there: N gives N, a dash a deletion, which is dropped if the deletions since
    the last base are whole codons or nothing follows, and otherwise put before the next base. With `seeds(key, seed)`, the
    seed's base stands for both, and a longer seed goes on. References without any base have no row.
    """
    order = Window.partitionBy(key).orderBy("pos")
    gone = F.col("token").isin("N", "-")
    best = tokens.groupBy(key, "pos").agg(
        F.min(F.when(~gone, F.struct((-F.col("n")).alias("n"), "token")))["token"].alias("token"),
        F.bool_or(F.col("token") == "N").alias("unsure"),
    )
    spans = best.groupBy(key).agg(F.max("pos").alias("last"), F.bool_or(F.col("token").isNotNull()).alias("any")).filter("any").drop("any")
    if seeds is not None:
        spans = spans.join(seeds, key, "left").withColumn("last", F.greatest("last", F.length("seed").cast("long")))
    else:
        spans = spans.withColumn("seed", F.lit(None).cast("string"))
    dense = spans.select(key, "seed", F.explode(F.sequence(F.lit(1).cast("long"), F.col("last").cast("long"))).alias("pos"))
    placed = dense.join(best, [key, "pos"], "left")
    deleted = F.col("token").isNull() & (F.col("unsure") == F.lit(False)) & F.col("seed").isNull()
    so_far = F.sum(F.when(deleted, 1).otherwise(0)).over(order)
    counted = placed.withColumn("dashes", so_far)
    before = F.last(F.when(F.col("token").isNotNull(), F.col("dashes")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    pending = F.col("dashes") - F.coalesce(before, F.lit(0))
    base = F.substring(F.col("seed"), F.col("pos").cast("int"), F.lit(1))
    called = F.concat(F.when(pending % 3 != 0, F.repeat(F.lit("-"), pending.cast("int"))).otherwise(""), "token")
    text = F.when(F.col("token").isNotNull(), called).when(F.col("seed").isNotNull(), base).when(deleted, "").otherwise("N")
    parts = counted.select(key, "pos", text.alias("text"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return parts.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("sequence"))


def attached_counts(report: DataFrame, clips: DataFrame, inserts: DataFrame, own_inserts: DataFrame, step: int = 1) -> DataFrame:
    """`report(seed, region, pos, idx)` with query_pos, clip_count and insertion_count.

    idx is the position, from 0, in the seed's consensus, null where there is none. Before a region's first idx and after its
    last one it goes on by `step` (3 for codons); between them a position without idx has no counts (null). `clips` and
    `inserts(seed, query_pos, n)` are of the consensus, `own_inserts(seed, region, pos, n)` of the report's positions.
    """
    region = Window.partitionBy("seed", "region")
    numbered = report.withColumn("_i", F.row_number().over(region.orderBy("pos")))
    known = F.when(F.col("idx").isNotNull(), F.struct("_i", "idx"))
    ends = numbered.withColumns({"_a": F.min(known).over(region), "_b": F.max(known).over(region)})
    i, a, b = F.col("_i"), F.col("_a"), F.col("_b")
    idx = F.when(i < a["_i"], (i - a["_i"]) * step + a["idx"]).when(i > b["_i"], (i - b["_i"]) * step + b["idx"]).otherwise(F.col("idx"))
    placed = ends.withColumn("query_pos", (idx + 1).cast("long")).drop("_i", "_a", "_b")
    named = lambda d, on, n: d.groupBy(*on).agg(F.sum("n").alias(n))
    joined = placed.join(named(clips, ["seed", "query_pos"], "_c"), ["seed", "query_pos"], "left").join(named(inserts, ["seed", "query_pos"], "_n"), ["seed", "query_pos"], "left")
    joined = joined.join(named(own_inserts, ["seed", "region", "pos"], "_o"), ["seed", "region", "pos"], "left")
    of = lambda *names: F.when(F.col("query_pos").isNotNull(), sum((F.coalesce(F.col(n), F.lit(0)) for n in names), F.lit(0)))
    return joined.select(*report.columns, "query_pos", of("_c").cast("long").alias("clip_count"), of("_n", "_o").cast("long").alias("insertion_count"))


def seed_concordance(segments: DataFrame, seeds: DataFrame, regions: DataFrame, contig: str = "contig") -> DataFrame:
    """contig, rname, region, pct_concordance, pct_covered of `segments(contig, rname, start, letters)`, matched stretches of aligned
    segments, against `seeds(rname, ref_pos, expected)` in the half-open `regions(region, start, end)`, a configured list.

    A position is covered if any segment matches there (a dash doesn't), and agrees if any of them has the seed's base. Percents are
    of the region's length and of what is covered (0 of nothing): a contig has a row for each region, of zeros where no segment is.

    Stretches are cut into blocks of positions; what a piece covers, and where it agrees, are bits, put together a contig and block.
    """
    block = lambda at: F.floor(at / BLOCK).cast("long")
    real = segments.filter(F.translate("letters", "-", "") != "").select(contig, "rname", "start", "letters", (F.col("start") + F.length("letters")).alias("end"))
    cut = real.select("*", F.explode(F.sequence(block(F.col("start")), block(F.col("end") - 1))).alias("block"))
    low, high = F.greatest("start", F.col("block") * BLOCK), F.least("end", (F.col("block") + 1) * BLOCK)
    pieces = cut.select(contig, "rname", "block", (low - F.col("block") * BLOCK).cast("int").alias("at"), F.substring(F.col("letters"), (low - F.col("start") + 1).cast("int"), (high - low).cast("int")).alias("piece"))
    of_block = seeds.filter(F.length("expected") == 1).groupBy("rname", block(F.col("ref_pos")).alias("block")).agg(F.map_from_entries(F.collect_list(F.struct(F.pmod("ref_pos", F.lit(BLOCK)).cast("int"), "expected"))).alias("_m"))
    known = of_block.select("rname", "block", F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.try_element_at("_m", i)).alias("expected"))
    met = pieces.join(known, ["rname", "block"], "left")
    own = F.split("piece", "")
    size = F.length("piece")
    number = lambda flags: F.conv(F.rpad(F.concat(F.repeat(F.lit("0"), F.col("at")), flags), BLOCK, F.lit("0")), 2, 10).cast("long")
    same = F.array_join(F.zip_with(own, F.slice("expected", F.col("at") + 1, size), lambda x, e: F.when((x == e) & (x != "-"), "1").otherwise("0")), "")
    there = F.when(F.col("piece").contains("-"), F.array_join(F.transform(own, lambda x: F.when(x == "-", "0").otherwise("1")), "")).otherwise(F.repeat(F.lit("1"), size))
    bits = met.groupBy(contig, "rname", "block").agg(F.bit_or(number(F.coalesce(same, F.lit("")))).alias("agree"), F.bit_or(number(there)).alias("covered"))
    spans = regions.select("region", F.col("start").alias("_start"), F.col("end").alias("_end"), F.explode(F.sequence(block(F.col("start")), block(F.col("end") - 1))).alias("block"))
    first, last = F.greatest("_start", F.col("block") * BLOCK) - F.col("block") * BLOCK, F.least("_end", (F.col("block") + 1) * BLOCK) - F.col("block") * BLOCK
    mask = F.conv(F.rpad(F.concat(F.repeat(F.lit("0"), first.cast("int")), F.repeat(F.lit("1"), (last - first).cast("int"))), BLOCK, F.lit("0")), 2, 10).cast("long")
    within = bits.join(F.broadcast(spans.select("region", "_start", "_end", "block", mask.alias("_mask"))), "block")
    count = lambda c: F.sum(F.bit_count(F.col(c).bitwiseAND(F.col("_mask"))))
    per = within.groupBy(contig, "rname", "region", "_start", "_end").agg(count("agree").alias("agree"), count("covered").alias("covered")).filter("covered > 0")
    shares = per.select(contig, "rname", "region", (100 * F.col("agree") / F.col("covered")).alias("pct_concordance"), (100 * F.col("covered") / (F.col("_end") - F.col("_start"))).alias("pct_covered"))
    wanted = bits.select(contig, "rname").distinct().crossJoin(F.broadcast(regions.select("region")))  # a configured list
    return wanted.join(shares, [contig, "rname", "region"], "left").fillna(0.0, ["pct_concordance", "pct_covered"])


def separate_matches(hits: DataFrame, contig: str = "contig", most: float = 0.1) -> DataFrame:
    """Of `hits(contig, ref, score, start, end, ord)`, those of the contig's best reference that were taken, best score first:
    a hit whose positions of [start, end) were taken already for less than `most`.

    A fold over a contig's hits, an aligner's few, in the row; on equal scores the first in input order comes first.
    """
    item = F.struct((-F.col("score")).alias("by"), "ord", "ref", "score", "start", "end")
    ordered = hits.filter(F.col("end") > F.col("start")).groupBy(contig).agg(F.array_sort(F.collect_list(item)).alias("all"))
    own = ordered.select(contig, F.filter("all", lambda x: x["ref"] == F.get(F.col("all"), 0)["ref"]).alias("own"))
    places = lambda x: F.sequence(x["start"], x["end"] - 1)
    none = F.struct(F.array().cast("array<bigint>").alias("held"), F.array().cast("array<bigint>").alias("taken"))

    def step(a: Column, x: Column) -> Column:
        fits = F.size(F.array_intersect(a["held"], places(x))) < most * (x["end"] - x["start"])
        return F.when(fits, F.struct(F.array_union(a["held"], places(x)).alias("held"), F.concat(a["taken"], F.array(x["ord"])).alias("taken"))).otherwise(a)

    folded = own.select(contig, "own", F.aggregate("own", none, step)["taken"].alias("taken"))
    kept = folded.select(contig, F.explode(F.filter("own", lambda x: F.array_contains(F.col("taken"), x["ord"]))).alias("x"))
    return kept.select(contig, "x.ref", "x.score", "x.start", "x.end", "x.ord")
