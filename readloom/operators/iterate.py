"""Rules of jobs that run in passes, over the tables that the passes leave."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stop_passes(counts: DataFrame, key: str, total: DataFrame, share: float = 0.95, most: int = 3) -> DataFrame:
    """key, stopped: the first pass after which mapping stops, of `counts(key, pass, ref, n)` and `total(key, reads)`.

    It stops when the references are those of the pass before and either none gained reads, more than `share` of the reads are
    mapped, or `most` passes are done. Keys that never stop have null.
    """
    before = counts.select(key, (F.col("pass") + 1).alias("pass"), "ref", F.col("n").alias("was"))
    passes = counts.select(key, "pass").distinct()
    both = counts.join(before.join(passes, [key, "pass"], "left_semi"), [key, "pass", "ref"], "full")
    per = both.groupBy(key, "pass").agg(
        F.bool_and(F.col("n").isNotNull() & F.col("was").isNotNull()).alias("same"),
        F.bool_or(F.coalesce(F.col("n") > F.col("was"), F.lit(True))).alias("gained"),
        F.sum("n").alias("mapped"),
    )
    enough = ~F.col("gained") | (F.col("mapped") > share * F.col("reads")) | (F.col("pass") >= most)
    stops = per.join(total, key).filter((F.col("pass") > 1) & F.col("same") & enough)
    return total.select(key).join(stops.groupBy(key).agg(F.min("pass").alias("stopped")), key, "left")
