"""Queries that write the tables in a file format of reads or reports and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.plans.registry import query
from readloom.sources import fastq, files


@query("s1_fastq", "SELECT concat(pair_id, ':', mate) AS name, seq, qual FROM reads", "reads")
def s1(reads: DataFrame) -> DataFrame:
    path = files.scratch(reads.sparkSession)
    files.write_fastq(reads.select(F.concat("pair_id", F.lit(":"), "mate").alias("name"), "seq", "qual"), path)
    return fastq.read_fastq(reads.sparkSession, path).drop("file", "at")


@query("s2_fasta", "SELECT concat('d', doc_id) AS name, seq AS sequence FROM seqs", "seqs")
def s2(seqs: DataFrame) -> DataFrame:
    path = files.scratch(seqs.sparkSession)
    files.write_fasta(seqs.select(F.concat(F.lit("d"), "doc_id").alias("name"), F.col("seq").alias("sequence")), path)
    return files.read_fasta(seqs.sparkSession, path)


@query("s3_sam", "SELECT qname, flag, rname, CAST(pos AS INT) AS pos, CAST(mapq AS INT) AS mapq, cigar, seq, qual FROM sam", "sam")
def s3(sam: DataFrame) -> DataFrame:
    path = files.scratch(sam.sparkSession)
    whole = sam.select("qname", "flag", "rname", "pos", "mapq", "cigar", F.lit("=").alias("rnext"), F.lit(0).alias("pnext"), F.lit(0).alias("tlen"), "seq", "qual")
    files.write_sam(whole, path)
    return files.read_sam(sam.sparkSession, path).drop("rnext", "pnext", "tlen", "score")


@query("s4_step_csv", "SELECT tile, cycle, errorrate FROM quality", "quality")
def s4(quality: DataFrame) -> DataFrame:
    path = files.scratch(quality.sparkSession)
    quality.write.csv(path, header=True)
    return files.read_step_csv(quality.sparkSession, path, "tile long, cycle int, errorrate double")


@query("s5_contig_table", "SELECT CASE WHEN k > 1 THEN concat(name, '_', k - 1) ELSE name END AS name, sequence FROM (SELECT coalesce(nullif(region, ''), concat('contig', i)) AS name, upper(letters) AS sequence, row_number() OVER (PARTITION BY coalesce(nullif(region, ''), concat('contig', i)) ORDER BY doc_id) AS k FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS region, row_number() OVER (ORDER BY doc_id) AS i FROM seqs))", "seqs")
def s5(seqs: DataFrame) -> DataFrame:
    rows = seqs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("source")).alias("region"), F.col("letters").alias("contig"))
    return files.contigs_of(rows, "doc_id")


@query("s6_overlap_json", "SELECT app, run_id, sample, depth::BIGINT AS overlap_size, line::BIGINT AS overlap_mismatches, CAST(concordance AS DOUBLE) AS overlap_pvalue FROM runs", "runs")
def s6(runs: DataFrame) -> DataFrame:
    path = files.scratch(runs.sparkSession)
    overlap = F.struct(F.col("depth").cast("long").alias("size"), F.col("line").cast("long").alias("mismatches"), F.col("concordance").cast("double").alias("pvalue"))
    runs.groupBy("app", "run_id", "sample").agg(F.collect_list(overlap).alias("overlaps")).write.json(path)
    return files.read_overlaps(runs.sparkSession, path)


@query("s7_statistics_json", "SELECT app, CAST(sum(depth) AS DOUBLE) AS depth, NULL AS absent FROM runs GROUP BY app", "runs")
def s7(runs: DataFrame) -> DataFrame:
    path = files.scratch(runs.sparkSession)
    runs.groupBy("app").agg(F.sum("depth").alias("depth"), F.count(F.lit(1)).alias("other")).write.json(path)
    return files.read_statistics(runs.sparkSession, path, "app string, depth double, absent string")


@query("s8_sectioned_csv", "SELECT run_id, line, CASE WHEN line <= 3 THEN 'Header' ELSE 'Data' END AS section, value FROM (SELECT run_id, line, concat('v', sum(depth)::BIGINT) AS value FROM runs GROUP BY run_id, line)", "runs")
def s8(runs: DataFrame) -> DataFrame:
    own = runs.groupBy("run_id", "line").agg(F.concat(F.lit("v"), F.sum("depth").cast("long")).alias("value")).withColumn("at", F.col("line") * 10)
    marks = runs.select("run_id").distinct().select("run_id", F.lit(0).alias("line"), F.explode(F.array(F.struct(F.lit("[Header]").alias("value"), F.lit(1).alias("at")), F.struct(F.lit("[Data]").alias("value"), F.lit(35).alias("at")))).alias("m"))
    lines = own.unionByName(marks.select("run_id", "line", "m.value", "m.at"), allowMissingColumns=True)
    return files.sections(lines, ["run_id"], "at").select("run_id", "line", "section", "value")


@query("s11_collated", "SELECT sample, app, count(*) AS n FROM runs GROUP BY ALL", "runs")
def s11(runs: DataFrame) -> DataFrame:
    path = files.scratch(runs.sparkSession)
    files.write_by_sample(runs.groupBy("sample", "app").agg(F.count(F.lit(1)).alias("n")), path)
    return files.collate(runs.sparkSession, path, "app string, n long")


@query("s9_sample_files", "SELECT sample, count(*) AS n, 1 AS files FROM (SELECT DISTINCT sample, run_id, line FROM runs) GROUP BY sample", "runs")
def s9(runs: DataFrame) -> DataFrame:
    path = files.scratch(runs.sparkSession)
    files.write_by_sample(runs.select("sample", "run_id", "line").distinct(), path)
    back = runs.sparkSession.read.schema("sample string, run_id long, line int").csv(path, header=True).withColumn("file", F.input_file_name())
    return back.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").cast("int").alias("files"))


@query("s10_sequence_files", "SELECT concat(pair_id, ':', mate) AS name, seq, upper(seq) AS sequence FROM reads", "reads")
def s10(reads: DataFrame) -> DataFrame:
    spark, named = reads.sparkSession, reads.select(F.concat("pair_id", F.lit(":"), "mate").alias("name"), "seq", "qual")
    fastq, fasta = files.scratch(spark), files.scratch(spark)
    files.write_fastq(named, fastq)
    files.write_fasta(named.select("name", F.col("seq").alias("sequence")), fasta)
    return files.read_fastq(spark, fastq).select("name", "seq").join(files.read_fasta(spark, fasta), "name")
