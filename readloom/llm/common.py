"""Helpers that several training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The white space that parts words: space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where it is unset and the master is local (tests) one of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        where = tempfile.mkdtemp(prefix="readloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def stash(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends here and nothing upstream runs twice.

    A written table rather than checkpoint(): a checkpoint of a plan evaluates its last stage twice.
    """
    path = f"{shared_dir(df.sparkSession)}/readloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Stands for a null doc_id where ids pass through pandas, which would make floats of a column with nulls.
NO_ID = -(1 << 63)


def filled_id(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))


def restored_id(doc_id: str = "doc_id") -> Column:
    return F.when(F.col(doc_id) != NO_ID, F.col(doc_id)).alias("doc_id")


def bucket_of(columns: list[str | Column], buckets: Column | int) -> Column:
    """A stable bucket from 0 to buckets - 1."""
    n = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.pmod(F.xxhash64(*columns, F.lit(7)), n.cast("long")).cast("int")


def numbered(df: DataFrame, key: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """Gapless numbers from 0 within `key`, where one key may hold most rows.

    Rows are numbered within (key, bucket); counts of the buckets, a small table, give each bucket its start.
    """
    starts = df.groupBy(*key, bucket).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    within = Window.partitionBy(*key, bucket).orderBy(*order)
    return (
        df.withColumn("_row", F.row_number().over(within).cast("long") - 1)
        .join(starts, [*key, bucket])
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_row", "_start")
    )
