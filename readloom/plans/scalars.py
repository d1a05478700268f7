"""Queries of projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import cigar, names, scores, seq
from readloom.functions.tables import mixture_codons, values
from readloom.plans.registry import query

_RC = "translate(reverse({0}), 'ACGT', 'TGCA')"


@query("p1_reverse_complement", "SELECT doc_id, translate(reverse(seq), 'ACGTRYSWKMBVDHN', 'TGCAYRWSMKVBHDN') AS rc FROM seqs", "seqs")
def p1(seqs: DataFrame) -> DataFrame:
    return seqs.select("doc_id", seq.reverse_complement_all("seq").alias("rc"))


@query("p2_reverse_complement_simple", f"SELECT doc_id, {_RC.format('seq')} AS rc FROM seqs", "seqs")
def p2(seqs: DataFrame) -> DataFrame:
    return seqs.select("doc_id", seq.reverse_complement("seq").alias("rc"))


@query("p3_canonical", f"SELECT pair_id, mate, least(seq, {_RC.format('seq')}) AS canonical FROM reads", "reads")
def p3(reads: DataFrame) -> DataFrame:
    return reads.select("pair_id", "mate", seq.canonical("seq").alias("canonical"))


@query(
    "p4_translate",
    f"""WITH codons AS (SELECT * FROM {values(mixture_codons(), 'codon, aminos')}),
    split AS (SELECT ord, unnest(range(0, length(seq) // 3)) AS i, seq FROM aligned),
    each AS (SELECT ord, i, substr(upper(seq), CAST(i * 3 + 1 AS INT), 3) AS codon FROM split),
    named AS (SELECT ord, i, e.codon, aminos, CASE WHEN e.codon = '---' THEN '-' WHEN aminos IS NULL THEN '?' WHEN length(aminos) = 1 THEN aminos ELSE '?' END AS a FROM each e LEFT JOIN codons c ON e.codon = c.codon),
    g AS (SELECT ord, string_agg(a, '' ORDER BY i) AS amino, count(*) AS codons, CAST(max(coalesce(length(aminos), 1)) AS BIGINT) AS most_aminos, count(*) FILTER (WHERE length(aminos) > 1) AS ambiguous FROM named GROUP BY ord)
    SELECT a.ord, coalesce(amino, '') AS amino, coalesce(codons, 0) AS codons, coalesce(most_aminos, CASE WHEN length(seq) > 0 THEN 1 ELSE 0 END) AS most_aminos, coalesce(ambiguous, 0) AS ambiguous FROM aligned a LEFT JOIN g ON g.ord = a.ord""",
    "aligned",
)
def p4(aligned: DataFrame) -> DataFrame:
    return seq.translate(aligned.select("ord", "seq")).select("ord", "amino", "codons", "most_aminos", "ambiguous")


_TOKENS = """tok AS (SELECT qname, flag, rname, pos, seq, qual, unnest(regexp_extract_all(cigar, '([0-9]+[MIDS])')) AS token, generate_subscripts(regexp_extract_all(cigar, '([0-9]+[MIDS])'), 1) - 1 AS n FROM sam WHERE cigar <> '*'),
 t2 AS (SELECT *, right(token, 1) AS op, CAST(left(token, length(token) - 1) AS INT) AS len FROM tok),
 tokens AS (SELECT *, CAST(coalesce(sum(CASE WHEN op IN ('M', 'I', 'S') THEN len ELSE 0 END) OVER w, 0) AS INT) AS q0, CAST(coalesce(sum(CASE WHEN op IN ('M', 'D') THEN len ELSE 0 END) OVER w, 0) AS INT) AS r0 FROM t2
   WINDOW w AS (PARTITION BY qname, flag ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 bases AS (SELECT qname, flag, rname, CAST(pos + r0 + i AS BIGINT) AS ref_pos, CASE WHEN op = 'M' THEN substr(seq, CAST(q0 + i + 1 AS INT), 1) ELSE '-' END AS base, CASE WHEN op = 'M' THEN ascii(substr(qual, CAST(q0 + i + 1 AS INT), 1)) - 33 ELSE -1 END AS q
   FROM (SELECT *, unnest(range(0, len)) AS i FROM tokens WHERE op IN ('M', 'D')))"""
KEY = ["qname", "flag", "rname"]


def tokens_of(sam: DataFrame) -> DataFrame:
    return cigar.tokens(sam.filter("cigar <> '*'"), KEY)


def inserting(sam: DataFrame) -> DataFrame:
    """The reads that have an insertion; only their cigars are parsed for it."""
    return sam.filter(F.col("cigar").contains("I"))


@query("p5_cigar_tokens", f"WITH {_TOKENS} SELECT qname, flag, n, op, len, q0, r0 FROM tokens", "sam")
def p5(sam: DataFrame) -> DataFrame:
    return tokens_of(sam).select("qname", "flag", "n", "op", "len", "q0", "r0")


@query("p6_aligned_bases", f"WITH {_TOKENS} SELECT rname, ref_pos, base, count(*) AS n, CAST(sum(q) AS BIGINT) AS q FROM bases GROUP BY ALL", "sam")
def p6(sam: DataFrame) -> DataFrame:
    return cigar.aligned_bases(tokens_of(sam), KEY).groupBy("rname", "ref_pos", "base").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"))


@query("p7_sam_flags", "SELECT qname, flag, (flag & 4) <> 0 AS unmapped, (flag & 8) <> 0 AS mate_unmapped, (flag & 64) <> 0 AS is_first FROM sam", "sam")
def p7(sam: DataFrame) -> DataFrame:
    flag = F.col("flag")
    return sam.select("qname", "flag", cigar.is_unmapped(flag).alias("unmapped"), cigar.is_mate_unmapped(flag).alias("mate_unmapped"), cigar.is_first(flag).alias("is_first"))


@query("p8_short_reads", "SELECT qname, flag, coalesce(list_max(list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda x: CAST(x AS INT))) <= 50, true) AS short FROM sam", "sam")
def p8(sam: DataFrame) -> DataFrame:
    return sam.select("qname", "flag", cigar.is_short_read(F.col("cigar")).alias("short"))


@query(
    "p11_contig_names",
    "SELECT id, regexp_replace(concat(id, '-', ref), '^[0-9]+-', '') AS trimmed, concat(CAST(id % 9 AS VARCHAR), '-', ref, CASE WHEN id % 7 = 0 THEN '-excluded' WHEN id % 5 = 0 THEN '-reversed' WHEN NOT (id % 3 = 0) THEN '-partial' ELSE '' END) AS named FROM spans",
    "spans",
)
def p11(spans: DataFrame) -> DataFrame:
    i = F.col("id")
    return spans.select("id", names.trimmed_contig_name(F.concat("id", F.lit("-"), "ref")).alias("trimmed"), names.contig_name(i % 9, F.col("ref"), i % 3 == 0, i % 5 == 0, i % 7 == 0).alias("named"))


_GENO = "CASE WHEN split_part(upper(seed), '-', 2) LIKE '1%' THEN CASE WHEN split_part(upper(seed), '-', 2) = '1B' THEN '1B' ELSE '1A' END WHEN split_part(upper(seed), '-', 2) = '6E' THEN '6E' ELSE left(split_part(upper(seed), '-', 2), 1) END"


@query("p12_genotype", f"SELECT DISTINCT seed, {_GENO} AS genotype FROM aminos", "aminos")
def p12(aminos: DataFrame) -> DataFrame:
    return aminos.select("seed", names.genotype(F.col("seed")).alias("genotype")).distinct()


@query(
    "p13_reported_regions",
    "SELECT ord, CASE WHEN r = 'INT' THEN 'IN' WHEN r LIKE 'HCV%' THEN regexp_extract(r, '([^-]*)$', 1) ELSE r END AS region, list_filter(['PR', 'RT', region], lambda x: x IN ('PR', 'R1', 'R2')) AS chosen FROM (SELECT *, CASE ord % 3 WHEN 0 THEN 'INT' WHEN 1 THEN concat('HCV1-', region) ELSE region END AS r FROM scores)",
    "scores",
)
def p13(rows: DataFrame) -> DataFrame:
    r = F.when(F.col("ord") % 3 == 0, "INT").when(F.col("ord") % 3 == 1, F.concat(F.lit("HCV1-"), "region")).otherwise(F.col("region"))
    return rows.select("ord", names.reported_region(r).alias("region"), names.selected_regions(F.array(F.lit("PR_RT"), F.col("region")), ["PR", "R1", "R2"]).alias("chosen"))


@query("p14_subtype", "SELECT seed, nullif(regexp_extract(h, '^(?:Ref\\.)?([0-9][a-z]+)\\.', 1), '') AS subtype FROM (SELECT DISTINCT seed, concat('Ref.', substr(seed, 5), '.x') AS h FROM aminos)", "aminos")
def p14(aminos: DataFrame) -> DataFrame:
    return aminos.select("seed").distinct().select("seed", names.subtype(F.concat(F.lit("Ref."), F.substring("seed", 5, 9), F.lit(".x"))).alias("subtype"))


@query(
    "p15_multi_sample_wells",
    "SELECT ord, i, split_part(w, '_', 1) AS sample, split_part(w, '_', 2) AS project, concat(regexp_replace(concat(sample, '.', region), '[_.;]', '-', 'g'), '_S', ord) AS file FROM (SELECT ord, sample, region, unnest(string_split(concat(sample, '_', region, ';', sample + 1, '_', seed), ';')) AS w, unnest([0, 1]) AS i FROM scores) x".replace("split_part(w, '_', 1) AS sample,", "split_part(w, '_', 1) AS well,"),
    "scores",
)
def p15(rows: DataFrame) -> DataFrame:
    wells = F.split(F.concat("sample", F.lit("_"), "region", F.lit(";"), F.col("sample") + 1, F.lit("_"), "seed"), ";")
    each = rows.select("ord", "sample", "region", F.posexplode(wells).alias("i", "w"))
    part = lambda n: F.get(F.split("w", "_"), n)
    return each.select("ord", "i", part(0).alias("well"), part(1).alias("project"), names.clean_file_name(F.concat("sample", F.lit("."), "region"), F.col("ord")).alias("file"))


@query(
    "p16_version_order",
    "SELECT version, row_number() OVER (ORDER BY contains(version, '-'), list_transform(regexp_extract_all(version, '([0-9]+)'), lambda x: CAST(x AS INT))) AS place FROM (SELECT DISTINCT concat('v', l_linenumber, '.', l_quantity::INT, CASE WHEN l_linenumber = 3 THEN '-rc' ELSE '' END) AS version FROM lineitem)",
    "lineitem",
)
def p16(lineitem: DataFrame) -> DataFrame:
    version = F.concat(F.lit("v"), "l_linenumber", F.lit("."), F.col("l_quantity").cast("int"), F.when(F.col("l_linenumber") == 3, "-rc").otherwise(""))
    from pyspark.sql import Window

    # one row a distinct version: a small table is ordered as a whole
    return lineitem.select(version.alias("version")).distinct().select("version", F.row_number().over(Window.orderBy(names.version_key(F.col("version")))).alias("place"))


_SCORE = "(4 * {m} - {l}) * pow({l}, -0.6)"


@query("p17_overlap_score", f"SELECT id, round({_SCORE.format(m='m', l='l')}, 6) AS score FROM (SELECT id, r_ei - r_st AS l, (r_ei - r_st) - id % 19 AS m FROM spans)", "spans")
def p17(spans: DataFrame) -> DataFrame:
    length = F.col("r_ei") - F.col("r_st")
    return spans.select("id", F.round(scores.overlap_score(length, length - F.col("id") % 19), 6).alias("score"))


@query(
    "p18_amplified_score",
    f"SELECT id, round(sign(a) * (999 + pow(999 * a, 2)), 2) AS score FROM (SELECT id, {_SCORE.format(m='m', l='l')} - {_SCORE.format(m='40', l='41')} AS a FROM (SELECT id, r_ei - r_st AS l, (r_ei - r_st) - id % 19 AS m FROM spans))",
    "spans",
)
def p18(spans: DataFrame) -> DataFrame:
    length = F.col("r_ei") - F.col("r_st")
    return spans.select("id", F.round(scores.amplified_overlap_score(length, length - F.col("id") % 19), 2).alias("score"))


@query(
    "p19_overlap_pvalue",
    """WITH pairs AS (SELECT DISTINCT CAST(n_chars % 40 AS INT) AS l, CAST((n_chars % 40) * (doc_id % 5) // 4 AS INT) AS m FROM documents),
    terms AS (SELECT l, m, unnest(range(m, l + 3)) AS k FROM pairs)
    SELECT l, m, round(sum(exp(lgamma(l + 3) - lgamma(k + 1) - lgamma(l + 3 - k) + k * ln(0.25) + (l + 2 - k) * ln(0.75))), 7) AS p FROM terms GROUP BY l, m""",
    "documents",
)
def p19(documents: DataFrame) -> DataFrame:
    length = (F.col("n_chars") % 40).cast("int")
    pairs = documents.select(length.alias("l"), F.floor(length * (F.col("doc_id") % 5) / 4).cast("int").alias("m")).distinct()
    return pairs.select("l", "m", F.round(scores.overlap_pvalue(F.col("l"), F.col("m")), 7).alias("p"))


@query("p21_coverage_scores", "SELECT id, CASE WHEN reads <= 300 THEN 1 WHEN reads <= 1000 THEN 2 WHEN reads <= 3000 THEN 3 ELSE 4 END AS on_score, CASE WHEN reads <= 0 THEN 0 WHEN reads <= 10 THEN -1 WHEN reads <= 100 THEN -2 ELSE -3 END AS off_score FROM spans", "spans")
def p21(spans: DataFrame) -> DataFrame:
    return spans.select("id", scores.on_score(F.col("reads"), (300, 1000, 3000)).alias("on_score"), scores.off_score(F.col("reads")).alias("off_score"))


@query(
    "p22_unpack_mixtures",
    f"""WITH probes AS (SELECT DISTINCT concat('AR', seq, 'YN') AS probe FROM pieces60),
    f AS (SELECT probe, concat('A', a, substr(probe, 3, length(probe) - 4), b, c) AS s FROM probes, (VALUES ('A'), ('G')) x(a), (VALUES ('C'), ('T')) y(b), (VALUES ('A'), ('C'), ('G'), ('T')) z(c))
    SELECT probe, s AS unpacked, false AS reversed FROM f UNION ALL SELECT probe, {_RC.format('s')}, true FROM f""",
    "pieces60",
)
def p22(pieces: DataFrame) -> DataFrame:
    probes = pieces.select(F.concat(F.lit("AR"), "seq", F.lit("YN")).alias("probe")).distinct()
    return seq.unpack_mixtures(probes, "probe")


@query("p24_cutoff_text", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 'MAX' ELSE printf('%.3f', l_discount) END AS cutoff FROM lineitem", "lineitem")
def p24(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber", names.cutoff_text(F.when(F.col("l_linenumber") != 1, F.col("l_discount").cast("double"))).alias("cutoff"))


@query("p25_adjusted_names", "SELECT DISTINCT seed, regexp_replace(regexp_replace(seed, '^HCV-([0-9])[ab]$', 'HCV\\1'), '^HCV6$', 'HCV6-EU') AS adjusted FROM aminos", "aminos")
def p25(aminos: DataFrame) -> DataFrame:
    return aminos.select("seed", names.adjusted(F.col("seed"), {r"^HCV-([0-9])[ab]$": "HCV$1", "^HCV6$": "HCV6-EU"}).alias("adjusted")).distinct()


@query("p26_gap_cuts", f"WITH {_TOKENS} SELECT qname, flag, CAST(pos + r0 + len // 2 AS BIGINT) AS cut FROM tokens WHERE op = 'D' AND len > 2", "sam")
def p26(sam: DataFrame) -> DataFrame:
    return cigar.gap_cut_points(tokens_of(sam), KEY, longer_than=2).select("qname", "flag", "cut")


@query("p27_add_primers", "SELECT doc_id, concat('ACGTACG', seq, 'TTGCA') AS seq, contains(seq, 'ACGTACG') AS has_forward, contains(seq, 'TTGCA') AS has_reverse FROM seqs", "seqs")
def p27(seqs: DataFrame) -> DataFrame:
    forward, reverse = F.lit("ACGTACG"), F.lit("TTGCA")
    return seqs.select("doc_id", F.concat(forward, "seq", reverse).alias("seq"), F.col("seq").contains(forward).alias("has_forward"), F.col("seq").contains(reverse).alias("has_reverse"))
