"""Alignments in files clustered by place, so that reads of a region are found without reading the others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions import cigar


def write_clustered(sam: DataFrame, path: str, group_bytes: int = 16 << 20) -> None:
    """Write the mapped reads of `sam(rname, pos, cigar, ...)` in order of (rname, pos): a range of places a file, each sorted.

    A column end, the last position that a read's matches and deletions reach, is added: a region is a range of two columns, and the
    bounds of row groups, of `group_bytes` each, tell which may hold some of its reads. Reads without a cigar ('*') are left out.
    """
    reach = F.aggregate(F.transform(F.regexp_extract_all("cigar", F.lit("([0-9]+)[MD]")), lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    placed = sam.filter(F.col("cigar").rlike(cigar.VALID) & (F.col("cigar") != "")).withColumn("end", F.col("pos") + reach - 1)
    placed.repartitionByRange("rname", "pos").sortWithinPartitions("rname", "pos").write.option("parquet.block.size", group_bytes).parquet(path)


def reads_in_region(spark: SparkSession, path: str, rname: str, first: int, last: int) -> DataFrame:
    """The reads in files of `write_clustered` that share a position with [first, last] of a reference."""
    return spark.read.parquet(path).filter((F.col("rname") == rname) & (F.col("pos") <= last) & (F.col("end") >= first))
