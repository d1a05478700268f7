"""Readers and writers of reads, contigs, alignments and reports. Paths go through Spark, so any store that it reads will do."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A field `AS:i:n` among the optional ones is the alignment's score.
SCORE = r"^AS:i:(-?[0-9]+)$"
SAM = "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string"


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        where = tempfile.mkdtemp(prefix="readloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/files/{uuid.uuid4().hex}"


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """file, record (from 0 within its file), name, seq, qual: four lines a record, plain or gz.

    A line's number is its place in its block of the file, as the scan numbers rows in order, and the lines of earlier blocks. Lines
    stay in the task that scans them until they meet in records: the starts of blocks, a row each, go to all tasks. A file is
    told by the number of its first line, as its path is longer than a line.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("lines"))
    upto = Window.partitionBy("file").orderBy("block")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first", F.first("first").over(upto).alias("_of"), F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("start"))
    placed = lines.join(F.broadcast(starts), ["file", "block"]).withColumn("n", F.col("start") + F.col("at") - F.col("first"))
    of = lambda k: F.max(F.when(F.col("n") % 4 == k, F.col("value")))
    whole = placed.filter("n % 4 <> 2").groupBy("_of", F.floor(F.col("n") / 4).alias("record")).agg(F.max("file").alias("file"), of(0).alias("name"), of(1).alias("seq"), of(3).alias("qual"))
    return whole.select("file", "record", F.regexp_replace("name", "^@", "").alias("name"), "seq", "qual")


def write_fastq(reads: DataFrame, path: str) -> None:
    """`reads(name, seq, qual)`, a record a row."""
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual").alias("value")).write.text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, sequence, the lines of a sequence joined: records are parted by a line's beginning '>', so files stay splittable."""
    records = spark.read.option("lineSep", "\n>").text(path)
    text = F.regexp_replace("value", "^>", "")
    found = records.select(F.substring_index(text, "\n", 1).alias("name"), F.regexp_replace(F.regexp_replace(text, "^[^\n]*", ""), r"\s", "").alias("sequence"))
    return found.filter("name <> ''")


def write_fasta(rows: DataFrame, path: str, width: int = 80) -> None:
    """`rows(name, sequence)` in lines of `width`."""
    body = F.regexp_replace("sequence", f"(.{{{width}}})(?=.)", "$1\n")
    rows.select(F.concat(F.lit(">"), "name", F.lit("\n"), body).alias("value")).write.text(path)


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """The first 11 fields of lines that aren't headers, and score, of the optional fields (null without one)."""
    fields = F.split("value", "\t")
    schema = T._parse_datatype_string(SAM)
    tags = F.filter(F.slice(fields, len(schema) + 1, F.greatest(F.size(fields), F.lit(1))), lambda x: x.rlike(SCORE))
    score = F.regexp_extract(F.get(tags, 0), SCORE, 1).cast("int").alias("score")
    return spark.read.text(path).filter(~F.col("value").startswith("@")).select(*(F.get(fields, i).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)), score)


def write_sam(sam: DataFrame, path: str) -> None:
    """Lines of the 11 fields, with the score as a tag where `sam` has a column of it and it isn't null."""
    names = [f.name for f in T._parse_datatype_string(SAM)]
    tags = [F.concat(F.lit("AS:i:"), F.col("score").cast("string"))] if "score" in sam.columns else []
    sam.select(F.concat_ws("\t", *(F.col(n).cast("string") for n in names), *tags).alias("value")).write.text(path)


def read_step_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report with a header and a fixed schema; an empty field is null."""
    return spark.read.schema(schema).csv(path, header=True, nullValue="", mode="FAILFAST")


def contigs_of(rows: DataFrame, order: str) -> DataFrame:
    """name, sequence of a contig table: the sequence is in `sequence` or `contig`, the name in `region`, `ref` or `sample`, else contig{i}.

    Empty is missing; where a row has only empty sequences, its sequence is empty, not null. A repeated name gets the suffix _{i}, from
    1; sequences are upper-cased. `order` tells rows apart, and may be null in one; names are numbered without their sequences.
    """
    from readloom.operators.ranks import numbered

    have = lambda names: [F.nullif(F.col(c).cast("string"), F.lit("")) for c in names if c in rows.columns]
    named = rows.select(F.col(order), F.coalesce(*have(["region", "ref", "sample"]), F.lit(None).cast("string")).alias("name"))
    named = numbered(named, [], [order], "_i").withColumn("name", F.coalesce("name", F.concat(F.lit("contig"), (F.col("_i") + 1).cast("string")))).drop("_i")
    again = numbered(named, ["name"], [order], "_again")
    final = again.select(F.col(order).alias("_order"), F.when(F.col("_again") > 0, F.concat("name", F.lit("_"), F.col("_again").cast("string"))).otherwise(F.col("name")).alias("name"))
    texts = [F.col(c).cast("string") for c in ("sequence", "contig") if c in rows.columns]
    sequence = F.upper(F.coalesce(*have(["sequence", "contig"]), *texts)).alias("sequence")
    return rows.select(order, sequence).join(final, F.col(order).eqNullSafe(F.col("_order"))).select("name", "sequence")


def read_overlaps(spark: SparkSession, path: str) -> DataFrame:
    """A row for each overlap in run statistics JSON, with the run's fields."""
    schema = "app string, run_id long, sample string, overlaps array<struct<size: long, mismatches: long, pvalue: double>>"
    runs = spark.read.schema(schema).json(path)
    return runs.select("app", "run_id", "sample", F.explode("overlaps").alias("o")).select("app", "run_id", "sample", F.col("o.size").alias("overlap_size"), F.col("o.mismatches").alias("overlap_mismatches"), F.col("o.pvalue").alias("overlap_pvalue"))


def read_statistics(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """Named fields of run statistics JSON; missing ones are null."""
    return spark.read.schema(fields).json(path)


def sections(lines: DataFrame, key: list[str], order: str, value: str = "value") -> DataFrame:
    """`lines` with section: the name of the last [Section] line at or before each; section lines themselves go."""
    name = F.nullif(F.regexp_extract(value, r"^\[(\w+)\]", 1), F.lit(""))
    upto = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumns({"_name": name, "section": F.last(name, ignorenulls=True).over(upto)}).filter("_name IS NULL").drop("_name")


def write_by_sample(rows: DataFrame, path: str, sample: str = "sample") -> None:
    """One CSV file a sample, in a folder named by it."""
    rows.repartition(sample).write.partitionBy(sample).csv(path, header=True)


def collate(spark: SparkSession, path: str, schema: str, sample: Column | None = None) -> DataFrame:
    """Files of many samples as one table, sample first: the files' own column, or else taken from the folder's name."""
    rows = spark.read.schema(schema).csv(f"{path}/*", header=True)
    own = sample if sample is not None else F.regexp_extract(F.input_file_name(), r"/(?:sample=)?([^/]+)/[^/]+$", 1)
    return rows if "sample" in rows.columns else rows.select(own.alias("sample"), "*")
