"""Exact k-mers: placement of reads, coverage from events, shared k-mers, entropy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators import stretches


#: Bases of a stretch that k-mers are cut from: finding a place in a string takes time in proportion to it.
STRETCH = 256


def windows(seqs: DataFrame, key: str, k: int) -> DataFrame:
    """key, start (from 0), kmer, size (of the whole) of all stretches of k letters of `seqs(key, seq)`; none for those shorter than k."""
    stretch = lambda i: F.struct((i * STRETCH).alias("at"), F.substring(F.col("seq"), i * STRETCH + 1, F.lit(STRETCH + k - 1)).alias("s"))
    last = F.floor((F.length("seq") - k) / STRETCH).cast("int")
    cut = seqs.filter(F.length("seq") >= k).select(key, F.length("seq").alias("size"), F.explode(F.transform(F.sequence(F.lit(0), last), stretch)).alias("x"))
    each = cut.select(key, "size", F.col("x.at").alias("at"), F.posexplode(F.transform(F.sequence(F.lit(1), F.length("x.s") - (k - 1)), lambda i: F.substring(F.col("x.s"), i, F.lit(k)))).alias("i", "kmer"))
    return each.select(key, (F.col("at") + F.col("i")).cast("long").alias("start"), "kmer", "size")


def kmers(seqs: DataFrame, key: str, k: int) -> DataFrame:
    """key, start (from 0), kmer of `seqs(key, seq)`; none for those shorter than k, none with an N."""
    return windows(seqs, key, k).drop("size").filter(~F.col("kmer").contains("N"))


def placements(reads: DataFrame, contigs: DataFrame, k: int) -> DataFrame:
    """contig, start, n: where reads of length k stand exactly, in either orientation.

    A palindromic read counts for both orientations. K-mers travel as stretches, see there.
    """
    return stretches.placed(reads, contigs, k)


def coverage(placed: DataFrame, contigs: DataFrame, k: int, inner: int = 0) -> DataFrame:
    """contig, pos (from 1), coverage at the positions where it changes: +n where a placement begins, -n after it ends.

    `inner` bases at each end of a placement don't count.
    """
    begin, end = F.col("start") + inner, F.col("start") + k - inner
    events = placed.select("contig", F.explode(F.array(F.struct(begin.alias("at"), F.col("n").alias("d")), F.struct(end.alias("at"), (-F.col("n")).alias("d")))).alias("e"))
    changes = events.groupBy("contig", (F.col("e.at") + 1).alias("pos")).agg(F.sum("e.d").alias("d"))
    order = Window.partitionBy("contig").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return changes.select("contig", "pos", F.sum("d").over(order).alias("coverage"))


def covered_bases(changes: DataFrame) -> DataFrame:
    """contig, covered, total: positions with any coverage, and the sum over positions, from the changes of coverage."""
    following = F.lead("pos").over(Window.partitionBy("contig").orderBy("pos"))
    spans = changes.withColumn("len", F.coalesce(following - F.col("pos"), F.lit(0)))
    return spans.groupBy("contig").agg(F.sum(F.when(F.col("coverage") > 0, F.col("len")).otherwise(0)).alias("covered"), F.sum(F.col("len") * F.col("coverage")).alias("total"))


def cut_support(changes: DataFrame, cuts: DataFrame, reach: int) -> DataFrame:
    """contig, support: the least coverage within `reach` of a cut; `changes` as of `coverage`."""
    following = F.lead("pos").over(Window.partitionBy("contig").orderBy("pos"))
    spans = changes.withColumn("next", following)
    joined = cuts.join(spans, "contig")
    near = (F.col("pos") <= F.col("cut") + reach) & (F.coalesce("next", F.col("cut") + reach + 1) > F.col("cut") - reach)
    first = F.min("pos")
    return joined.groupBy("contig", "cut").agg(F.min(F.when(near, F.col("coverage"))).alias("least"), first.alias("first")).select("contig", F.when(F.col("first") > F.col("cut") - reach, 0).otherwise(F.col("least")).alias("support"))


def sharing(seqs: DataFrame, key: str, k: int) -> DataFrame:
    """Which of `seqs(key, seq)` share a k-mer, as classes: a row for each class and member, with first (the class's smallest key),
    members, kmers (how many k-mers these members, and no others, have), and always (false).

    Two sequences share a k-mer if, and only if, both are in one class, so no link is lost and none is a row. A sequence of fewer
    than k letters passes as sharing one with all: its row has no class and always is true. Repeated rows of a key are one
    sequence's pieces. A null sequence has none. K-mers travel as stretches, see there.
    """
    held = stretches.owner_classes(seqs, key, k).withColumn("always", F.lit(False))
    none = F.lit(None).cast("long")
    short = seqs.filter(F.length("seq") < k).select(key, F.lit(None).cast(seqs.schema[key].dataType).alias("first"), none.alias("members"), none.alias("kmers"), F.lit(True).alias("always"))
    return held.unionByName(short)


#: K-mers that a task counts before it passes the counts on, and the most letters that two bits each fit a long.
HELD, CODED = 1 << 22, 31


def _coded(texts: list[str], k: int) -> tuple[np.ndarray, list[str]]:
    """The k-mers of A, C, G and T as numbers of two bits a letter, and those with others as they are; none that holds an N."""
    kind = np.full(256, 4, np.uint8)
    kind[[*b"ACGT"]], kind[[*b"N\n"]] = range(4), 5
    whole = "\n".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = kind[np.minimum(points, 255)]
    n = len(letters) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), []
    none = lambda x: (lambda c: c[k:] == c[:-k])(np.concatenate([[0], x.cumsum()]))
    whole_ones, plain = none(letters == 5), none(letters >= 4)
    part, done, size, code = (letters & 3).astype(np.int64), 0, 1, None
    while done < k:
        if k & size:
            own = part[done : done + n]
            code, done = own if code is None else code << 2 * size | own, done + size
        part, size = part[: len(part) - size] << 2 * size | part[size:], 2 * size
    return code[plain], [whole[i : i + k] for i in np.flatnonzero(whole_ones & ~plain).tolist()]


def counted(reads: DataFrame, key: str, k: int) -> DataFrame:
    """key, kmer, n: how often each k-mer, as a number or (others than A, C, G, T in it) as text, is in `reads(key, seq)`; none with an N.

    A task counts some millions at a time, so a row stands for a k-mer of these, not for a place.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[object, list[str]] = {}
        room = HELD

        def passed() -> Iterator[pd.DataFrame]:
            for name, texts in held.items():
                codes, others = _coded(texts, k)
                for kind, found in (("code", codes), ("kmer", np.array(others, object))):
                    if len(found):
                        values, n = np.unique(found, return_counts=True)
                        frame = pd.DataFrame({"key": [name] * len(n), "code": None, "kmer": None, "n": n})
                        frame[kind] = values
                        yield frame

        for batch in batches:
            for name, text in zip(batch["key"], batch["seq"], strict=True):
                for at in range(0, len(text) - k + 1, HELD):
                    part = text[at : at + HELD + k - 1]
                    held.setdefault(None if pd.isna(name) else name, []).append(part)
                    room -= len(part)
                    if room <= 0:
                        yield from passed()
                        held, room = {}, HELD
        yield from passed()

    if k > CODED:
        return kmers(reads, key, k).groupBy(key, "kmer").agg(F.count(F.lit(1)).alias("n"))
    kind = reads.schema[key].dataType
    found = reads.filter(F.length("seq") >= k).select(F.col(key).cast("string").alias("key"), "seq").mapInPandas(run, "key string, code long, kmer string, n long")
    total = found.groupBy("key", "code", "kmer").agg(F.sum("n").alias("n"))
    return total.select(F.col("key").cast(kind).alias(key), F.coalesce("kmer", F.col("code").cast("string")).alias("kmer"), "n")


def entropy(reads: DataFrame, key: str, k: int = 12) -> DataFrame:
    """key, entropy in bits of its k-mer counts: the logarithm of their sum, less the mean of their own."""
    each = counted(reads, key, k).groupBy(key).agg(F.sum("n").alias("_t"), F.sum(F.col("n") * F.log2("n")).alias("_s"))
    return each.select(key, (F.log2("_t") - F.col("_s") / F.col("_t")).alias("entropy"))


#: Letters of sequences, each a digit of base 16: what a k-mer of up to LONGEST letters says fits a long.
LETTERS, DIGITS = "ACGTN-RYKMSWBDHV", "0123456789ABCDEF"
LONGEST = 15


def match_spectrum(contigs: DataFrame, sequence: str, most: int) -> DataFrame:
    """size, kmer, matches, occurrences: how many k-mers left and right of each distinct k-mer, apart from it, match it in so
    many places, for each k up to `most` (LONGEST at most), added up over contigs. A k-mer's last place in a contig counts.

    A k-mer is a number of four bits a letter. Two numbers differ by exclusive or, and the letters that do are counted at once, so a
    pair costs a few operations whatever k is. Pairs are counted in the stage that makes them and never shuffled; their number
    grows with the square of a contig. Other letters count as one.
    """
    if most > LONGEST:
        raise ValueError(f"k-mers have up to {LONGEST} letters")
    seq, k, i = F.col(sequence), F.col("size"), F.col("i")
    digits = F.regexp_replace(F.translate(seq, LETTERS, DIGITS), "[^0-9A-F]", "F")
    sized = contigs.select(sequence, digits.alias("_digits"), F.explode(F.sequence(F.lit(1), F.lit(most))).alias("size")).filter(F.length(sequence) >= k)
    number = lambda j: F.conv(F.substring(F.col("_digits"), j + 1, k), 16, 10).cast("long")
    coded = sized.withColumn("_codes", F.transform(F.sequence(F.lit(0), F.length(sequence) - k), number))
    places = coded.select(sequence, "size", "_codes", F.posexplode("_codes").alias("i", "_own"))
    own = places.withColumn("kmer", F.substring(seq, i + 1, k)).filter(F.expr(f"locate(kmer, `{sequence}`, i + 2)") == 0)
    pairs = own.select("size", "kmer", "i", "_own", F.posexplode("_codes").alias("j", "_other")).filter(F.abs(F.col("j") - i) >= k)
    x = F.col("_own").bitwiseXOR(F.col("_other"))
    any_bit = x.bitwiseOR(F.shiftright(x, 1)).bitwiseOR(F.shiftright(x, 2)).bitwiseOR(F.shiftright(x, 3)).bitwiseAND(F.lit(0x111111111111111))
    return pairs.withColumn("matches", k - F.bit_count(any_bit)).filter("matches > 0").groupBy("size", "kmer", "matches").agg(F.count(F.lit(1)).alias("occurrences"))
