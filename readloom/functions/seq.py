"""Sequence expressions: complements, canonical forms, translation, mixtures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.tables import BASES_OF, CODON_DIGITS, COMPLEMENT_FROM, COMPLEMENT_TO, SIMPLE_FROM, SIMPLE_TO, codon_sets


def reverse_complement_all(seq: Column | str) -> Column:
    """Over the 15 letters of bases and mixtures; any other letter is an error."""
    col = F.col(seq) if isinstance(seq, str) else seq
    done = F.translate(F.reverse(col), COMPLEMENT_FROM, COMPLEMENT_TO)
    return F.when(col.rlike(f"^[{COMPLEMENT_FROM}]*$"), done).otherwise(F.raise_error(F.lit("unknown base")).cast("string"))


def reverse_complement(seq: Column | str) -> Column:
    """Over A, C, G, T; other letters stay as they are."""
    return F.translate(F.reverse(seq), SIMPLE_FROM, SIMPLE_TO)


def canonical(seq: Column | str) -> Column:
    """The lesser of a sequence and its reverse complement."""
    return F.least(seq, reverse_complement(seq))


def translate(reads: DataFrame, seq: str = "seq", offset: int = 0, list_ambiguous: bool = False, resolve: bool = False, return_list: bool = False) -> DataFrame:
    """`reads` with amino (a letter a codon), codons, and most_aminos, ambiguous: statistics of its mixtures.

    Letters may be small. A dash in a codon counts as N; two dashes or more, or an unknown letter, give '?' but for '---', which
    is '-'. A codon of several aminos is '?', or their list in brackets, or (`resolve`) the first of them. With `return_list`,
    amino is an array of all aminos of each codon. An incomplete last codon is dropped. `offset` dashes are put first. A null
    sequence is empty; most_aminos is 1 at least for one that isn't. All within the row: a codon's letters are the digits of
    its number in a fixed table.
    """
    digits = F.translate(F.concat(F.lit("-" * offset), F.upper(seq)), *CODON_DIGITS)
    table = F.array(*(F.lit(x) for x in codon_sets()))
    known = lambda c: F.when(c.rlike("^[0-9A-F]{3}$"), F.get(table, F.conv(c, 16, 10).cast("int")))
    sets = reads.withColumn("_sets", F.transform(F.regexp_extract_all(digits, F.lit("(.{3})")), known))
    several = lambda x: F.substring(x, 1, 1) if resolve else F.concat(F.lit("["), x, F.lit("]")) if list_ambiguous else F.lit("?")
    one = lambda x: F.coalesce(F.when(F.length(x) > 1, several(x)).otherwise(x), F.lit("?"))
    size = lambda x: F.when(x == "-", 0).otherwise(F.coalesce(F.length(x), F.lit(0)))
    own = F.col("_sets")
    amino = F.transform(own, lambda x: F.filter(F.split(F.coalesce(x, F.lit("?")), ""), lambda y: y != "")) if return_list else F.array_join(F.transform(own, one), "")
    found = {
        "amino": F.coalesce(amino, F.array().cast("array<array<string>>") if return_list else F.lit("")),
        "codons": F.coalesce(F.size(own), F.lit(0)).cast("long"),
        "most_aminos": F.when(F.length(digits) > 0, F.greatest(F.lit(1), F.coalesce(F.array_max(F.transform(own, size)), F.lit(0)))).otherwise(0).cast("long"),
        "ambiguous": F.coalesce(F.size(F.filter(own, lambda x: F.length(x) > 1)), F.lit(0)).cast("long"),
    }
    return sets.withColumns(found).drop("_sets")


def call_error() -> Column:
    """The first reason not to call a read, or null; over seq, amino and the statistics of its translation."""
    text, prot = F.col("seq"), F.col("amino")
    size = F.length(text)
    low = 2 * (size - F.length(F.translate(F.upper(text), "N", ""))) > size
    return (
        F.when(low, "low quality").when(size == 0, "zerolength").when(size % 3 != 0, "notdiv3")
        .when(~(prot.startswith("C") & prot.endswith("C")), "cysteines").when((F.col("ambiguous") > 1) | (F.col("most_aminos") > 2), "> 2 ambiguous")
        .when(prot.contains("*"), "stop codons").when((F.length(prot) < 32) | (F.length(prot) > 40), "length")
    )


def concrete_sequences(seq: Column | str) -> Column:
    """All sequences of plain bases that a sequence of mixtures may stand for."""
    col = F.col(seq) if isinstance(seq, str) else seq
    bases = F.create_map(*(x for code, own in BASES_OF.items() for x in (F.lit(code), F.array(*map(F.lit, own)))))
    own = lambda x: F.when(F.length(x) > 1, F.array(x)).otherwise(F.element_at(bases, x))
    step = lambda done, x: F.flatten(F.transform(done, lambda d: F.transform(own(x), lambda b: F.concat(d, b))))
    parts = F.regexp_extract_all(col, F.lit("([ACGT]+|(?s:.))"))  # plain bases go as one
    return F.aggregate(parts, F.array(F.lit("")), step)


def unpack_mixtures(probes: DataFrame, seq: str = "seq") -> DataFrame:
    """A row for each concrete sequence of `probes`, and one for its reverse complement: unpacked, reversed."""
    forward = probes.withColumn("unpacked", F.explode(concrete_sequences(seq)))
    both = F.array(F.struct(F.col("unpacked").alias("s"), F.lit(False).alias("r")), F.struct(reverse_complement("unpacked").alias("s"), F.lit(True).alias("r")))
    return forward.withColumn("_b", F.explode(both)).withColumn("unpacked", F.col("_b.s")).withColumn("reversed", F.col("_b.r")).drop("_b")
