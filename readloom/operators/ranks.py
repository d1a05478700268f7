"""Gapless numbers within keys of which one may hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.sources.files import scratch


def numbered(rows: DataFrame, key: list[str], order: list[str | Column], name: str) -> DataFrame:
    """`rows` with numbers from 0 by `order` within `key`: rows are numbered within ranges of (key, order), to which the counts of
    the key's earlier ranges are added.

    Ranges are written once, as the bounds of another evaluation might differ. Only counts, a row a key and range, meet in one task.
    """
    path = scratch(rows.sparkSession)
    rows.repartitionByRange(*key, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    placed = rows.sparkSession.read.parquet(path)
    before = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*key, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    starts = starts.select(*(F.col(k).alias(f"_of_{k}") for k in key), F.col("_range").alias("_of"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(*key, "_range").orderBy(*order)) - 1
    same = F.col("_range") == F.col("_of")
    for k in key:
        same &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    found = placed.withColumn("_row", within).join(starts, same).withColumn(name, F.col("_start") + F.col("_row"))
    return found.select(*(c for c in rows.columns if c != name), name)
