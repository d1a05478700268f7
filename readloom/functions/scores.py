"""Scores of overlaps, calls and coverage as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap_score(length: Column, matches: Column) -> Column:
    """(4 matches - length) x length^-0.6; 0 for no length."""
    return F.when(length > 0, (4 * matches - length) * F.pow(length.cast("double"), F.lit(-0.6))).otherwise(0.0)


#: The score that is amplified from: 40 matches of 41.
AMPLIFY_LENGTH, AMPLIFY_MATCHES = 41, 40


def amplified_overlap_score(length: Column, matches: Column) -> Column:
    """sign x (999 + (999 (score - base))^2) with the base of AMPLIFY_MATCHES in AMPLIFY_LENGTH; 0 for no length."""
    away = overlap_score(length, matches) - overlap_score(F.lit(AMPLIFY_LENGTH), F.lit(AMPLIFY_MATCHES))
    return F.when(length > 0, F.signum(away) * (999 + F.pow(999 * away, F.lit(2)))).otherwise(0.0)


def overlap_pvalue(length: Column, matches: Column, chance: float = 0.25) -> Column:
    """Probability of at least `matches` chance matches in length + 2 trials, by a product recurrence over the tail."""
    n = length + 2
    start = F.aggregate(F.sequence(F.lit(1), n), F.lit(1.0), lambda a, i: a * F.when(i <= matches, (n - matches + i) / i * chance).otherwise(1 - chance))
    first = F.when(matches == 0, F.pow(F.lit(1 - chance), n)).otherwise(start)
    sums = F.aggregate(
        F.sequence(matches.cast("int"), n.cast("int")),
        F.struct(first.alias("term"), F.lit(0.0).alias("sum")),
        lambda a, k: F.struct((a["term"] * (n - k) / (k + 1) * (chance / (1 - chance))).alias("term"), (a["sum"] + a["term"]).alias("sum")),
    )["sum"]
    return F.when(matches > n, 0.0).otherwise(F.least(sums, F.lit(1.0)))


def on_score(coverage: Column, thresholds: tuple[int, int, int]) -> Column:
    a, b, c = thresholds
    return F.when(coverage <= a, 1).when(coverage <= b, 2).when(coverage <= c, 3).otherwise(4)


def off_score(coverage: Column) -> Column:
    return F.when(coverage <= 0, 0).when(coverage <= 10, -1).when(coverage <= 100, -2).otherwise(-3)
