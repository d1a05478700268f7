"""Expressions on names: contigs, genotypes, regions, headers, versions, cutoffs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed_contig_name(name: Column) -> Column:
    """Without the number before the first dash: 1-HIV becomes HIV."""
    return F.regexp_replace(name, r"^[0-9]+-", "")


def contig_name(prefix: Column, ref: Column, is_match: Column, is_reversed: Column, is_excluded: Column) -> Column:
    suffix = F.when(is_excluded, "-excluded").when(is_reversed, "-reversed").when(~is_match, "-partial").otherwise("")
    return F.concat(prefix.cast("string"), F.lit("-"), ref, suffix)


def genotype(seed: Column) -> Column:
    """From HCV seeds: type 1 is 1A unless 1B; 6E stays; of others the digit."""
    whole = F.upper(F.get(F.split(seed, "-"), 1))
    return F.when(whole.startswith("1"), F.when(whole == "1B", "1B").otherwise("1A")).when(whole == "6E", whole).otherwise(F.substring(whole, 1, 1))


def reported_region(reference: Column) -> Column:
    """INT is reported as IN; of an HCV region what follows its last dash."""
    return F.when(reference == "INT", "IN").otherwise(F.when(reference.startswith("HCV"), F.regexp_extract(reference, "([^-]*)$", 1)).otherwise(reference))


def selected_regions(choices: Column, reported: list[str]) -> Column:
    """Regions of choices like PR_RT that are reported, in their order."""
    return F.array_intersect(F.flatten(F.transform(choices, lambda c: F.split(c, "_"))), F.array(*map(F.lit, reported)))


def subtype(header: Column) -> Column:
    """The subtype that begins a reference header, like 1a; null where there is none."""
    found = F.regexp_extract(header, r"^(?:Ref\.)?([0-9][a-z]+)\.", 1)
    return F.when(found != "", found)


def clean_file_name(name: Column, number: Column) -> Column:
    return F.concat(F.regexp_replace(name, "[_.;]", "-"), F.lit("_S"), number.cast("string"))


def version_key(name: Column) -> Column:
    """Sorts versions by all their numbers; one with a modifier goes after those without."""
    numbers = F.transform(F.regexp_extract_all(name, F.lit("([0-9]+)")), lambda x: x.cast("int"))
    return F.struct(name.contains("-").alias("modified"), numbers.alias("numbers"))


def cutoff_text(cutoff: Column) -> Column:
    """MAX for null, else three decimals."""
    return F.when(cutoff.isNull(), "MAX").otherwise(F.format_string("%.3f", cutoff))


def adjusted(name: Column, renames: dict[str, str]) -> Column:
    """A seed's or region's name as the other release has it, by patterns."""
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), renames.items(), name)
