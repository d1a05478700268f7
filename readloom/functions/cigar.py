"""CIGAR strings as rows: tokens, aligned bases, insertions, clipped positions; SAM flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNMAPPED, MATE_UNMAPPED, FIRST = 0x4, 0x8, 0x40
VALID = "^([0-9]+[MIDS])*$"
SHORT = 50


def is_unmapped(flag: Column) -> Column:
    return flag.bitwiseAND(UNMAPPED) != 0


def is_mate_unmapped(flag: Column) -> Column:
    return flag.bitwiseAND(MATE_UNMAPPED) != 0


def is_first(flag: Column) -> Column:
    return flag.bitwiseAND(FIRST) != 0


def longest_match(cigar: Column) -> Column:
    return F.array_max(F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+)M")), lambda x: x.cast("int")))


def is_short_read(cigar: Column, most: int = SHORT) -> Column:
    """No run of matches is longer than `most`; a read without matches is short."""
    return F.coalesce(longest_match(cigar) <= most, F.lit(True))


def is_valid(cigar: Column, seq: Column) -> Column:
    """Only M, I, D, S tokens, which use up the sequence exactly."""
    return fits(cigar, F.length(seq))


def fits(cigar: Column, size: Column) -> Column:
    """As `is_valid`, of the sequence's length."""
    used = F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+)[MIS]")), lambda x: x.cast("int"))
    return cigar.rlike(VALID) & (F.aggregate(used, F.lit(0), lambda a, x: a + x) == size)


def token_array(cigar: Column) -> Column:
    """array<struct<op, len, q0, r0>> of a valid cigar: q0 bases of the read and r0 of the reference are before the token.

    A fold within the row: offsets need no rows of tokens, so no shuffle brings them together again.
    """
    token = lambda t: F.struct(F.substring(t, -1, 1).alias("op"), F.regexp_extract(t, "([0-9]+)", 1).cast("int").alias("len"))
    parts = F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+[MIDS])")), token)
    none = F.array().cast("array<struct<op: string, len: int, q0: int, r0: int>>")
    start = F.struct(F.lit(0).alias("q"), F.lit(0).alias("r"), none.alias("found"))

    def step(a: Column, t: Column) -> Column:
        used = lambda *ops: F.when(t["op"].isin(*ops), t["len"]).otherwise(0)
        own = F.struct(t["op"].alias("op"), t["len"].alias("len"), a["q"].alias("q0"), a["r"].alias("r0"))
        return F.struct((a["q"] + used("M", "I", "S")).alias("q"), (a["r"] + used("M", "D")).alias("r"), F.concat(a["found"], F.array(own)).alias("found"))

    return F.aggregate(parts, start, step)["found"]


def tokens(reads: DataFrame, key: list[str]) -> DataFrame:
    """A row for each token of a valid cigar: key, pos, seq, qual, n, op, len, q0 (bases of the read before), r0 (of the reference)."""
    split = reads.filter(is_valid(F.col("cigar"), F.col("seq"))).select(*key, "pos", "seq", "qual", F.posexplode(token_array(F.col("cigar"))).alias("n", "t"))
    return split.select(*key, "pos", "seq", "qual", "n", "t.*")


def counted_tokens(reads: DataFrame, key: list[str]) -> DataFrame:
    """A row for each token of each valid alignment, with how many reads have it: key, pos, reads, op, len, q0, r0.

    Reads of one place, cigar and length are one alignment, so a cigar is parsed once for all of them.
    """
    alike = reads.groupBy(*key, "pos", "cigar", F.length("seq").alias("_size")).agg(F.count(F.lit(1)).alias("reads"))
    split = alike.filter(fits(F.col("cigar"), F.col("_size"))).select(*key, "pos", "reads", F.explode(token_array(F.col("cigar"))).alias("t"))
    return split.select(*key, "pos", "reads", "t.*")


def coverage(counted: DataFrame, key: list[str]) -> DataFrame:
    """key, ref_pos, coverage: reads with a base or a deletion there, of `counted_tokens`."""
    first = (F.col("pos") + F.col("r0")).cast("long")
    held = counted.filter("op IN ('M', 'D') AND len > 0").groupBy(*key, first.alias("first"), "len").agg(F.sum("reads").alias("reads"))
    each = held.select(*key, "reads", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("len") - 1)).alias("ref_pos"))
    return each.groupBy(*key, "ref_pos").agg(F.sum("reads").alias("coverage"))


def matched_stretches(found: DataFrame, key: list[str]) -> DataFrame:
    """key, start (reference position), letters: the whole stretches of M tokens."""
    matched = found.filter("op = 'M' AND len > 0")
    return matched.select(*key, (F.col("pos") + F.col("r0")).cast("long").alias("start"), F.substring(F.col("seq"), F.col("q0") + 1, F.col("len")).alias("letters"))


def phred(char: Column) -> Column:
    return F.ascii(char) - 33


def aligned_bases(found: DataFrame, key: list[str]) -> DataFrame:
    """A row for each reference position of M and D tokens: key, ref_pos (from 1), base ('-' in a deletion), q (-1 there)."""
    rows = found.filter("op IN ('M', 'D') AND len > 0").select(*key, "pos", "seq", "qual", "op", "q0", "r0", F.explode(F.sequence(F.lit(0), F.col("len") - 1)).alias("i"))
    at = F.col("q0") + F.col("i") + 1
    match = F.col("op") == "M"
    return rows.select(
        *key,
        (F.col("pos") + F.col("r0") + F.col("i")).cast("long").alias("ref_pos"),
        F.when(match, F.substring(F.col("seq"), at, F.lit(1))).otherwise("-").alias("base"),
        F.when(match, phred(F.substring(F.col("qual"), at, F.lit(1)))).otherwise(-1).alias("q"),
    )


def insertions(found: DataFrame, key: list[str]) -> DataFrame:
    """A row for each insertion: key, ref_pos of the base before it, insert, insert_qual."""
    cut = lambda c: F.substring(F.col(c), F.col("q0") + 1, F.col("len"))
    return found.filter("op = 'I'").select(*key, (F.col("pos") + F.col("r0") - 1).cast("long").alias("ref_pos"), cut("seq").alias("insert"), cut("qual").alias("insert_qual"))


def clipped_positions(found: DataFrame, key: list[str]) -> DataFrame:
    """A row for each reference position that a soft clip would cover: before the read's start (0 and less too), or from where it got to."""
    first = F.col("q0") == 0
    start = F.col("pos") + F.col("r0") - F.when(first, F.col("len")).otherwise(0)
    rows = found.filter("op = 'S' AND len > 0").select(*key, start.alias("start"), F.explode(F.sequence(F.lit(0), F.col("len") - 1)).alias("i"))
    return rows.select(*key, (F.col("start") + F.col("i")).cast("long").alias("ref_pos"))


def gap_cut_points(found: DataFrame, key: list[str], longer_than: int = 600) -> DataFrame:
    """The middle of each deletion longer than `longer_than`: key, cut (reference position)."""
    return found.filter((F.col("op") == "D") & (F.col("len") > longer_than)).select(*key, (F.col("pos") + F.col("r0") + F.floor(F.col("len") / 2)).cast("long").alias("cut"))


def aligned_strings(seq: Column, qual: Column, pos: Column, cigar: Column) -> Column:
    """struct<seq, qual> of a read laid on its reference from position 1: dashes of quality ! before it, of quality space in deletions."""
    parts = F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+[MIDS])")), lambda t: F.struct(F.substring(t, -1, 1).alias("op"), F.regexp_extract(t, "([0-9]+)", 1).cast("int").alias("n")))
    start = F.struct(F.repeat(F.lit("-"), (pos - 1).cast("int")).alias("seq"), F.repeat(F.lit("!"), (pos - 1).cast("int")).alias("qual"), F.lit(0).alias("used"))

    def step(a: Column, t: Column) -> Column:
        add = lambda text, gap: F.when(t["op"] == "M", F.substring(text, a["used"] + 1, t["n"])).when(t["op"] == "D", F.repeat(F.lit(gap), t["n"])).otherwise("")
        return F.struct(F.concat(a["seq"], add(seq, "-")).alias("seq"), F.concat(a["qual"], add(qual, " ")).alias("qual"), (a["used"] + F.when(t["op"] == "D", 0).otherwise(t["n"])).alias("used"))

    whole = F.aggregate(parts, start, step)
    return F.struct(whole["seq"].alias("seq"), whole["qual"].alias("qual"))
