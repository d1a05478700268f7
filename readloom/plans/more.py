"""Queries of lookups, insertions, region summaries, search hits and mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import cigar
from readloom.functions.tables import values
from readloom.operators import counts, iterate, kmers, summaries
from readloom.plans.calls import _PLACED, placed_of
from readloom.plans.reads import _CONS, _INSERTS, _LONG, _WIDE
from readloom.plans.registry import query
from readloom.plans.scalars import _TOKENS, KEY, inserting, tokens_of

FPR = [(round(0.05 * i, 2), round((20 - i) ** 2 / 4.0, 3)) for i in range(21)]


@query(
    "j10_nearest_lookup",
    f"WITH f AS (SELECT score, fpr FROM {values(FPR, 'score, fpr')}), v AS (SELECT DISTINCT CAST(run_time AS DOUBLE) / 50000 AS g FROM runs), d AS (SELECT g, first(fpr ORDER BY abs(score - g), score) AS fpr FROM v, f WHERE g BETWEEN 0 AND 1 GROUP BY g) SELECT v.g, fpr FROM v LEFT JOIN d ON d.g = v.g",
    "runs",
)
def j10(runs: DataFrame) -> DataFrame:
    table = runs.sparkSession.createDataFrame(FPR, "score double, fpr double")
    return summaries.nearest(runs.select((F.col("run_time").cast("double") / 50000).alias("g")).distinct(), "g", table)


_PLACES = range(1, 8)
_WEIGHTS = [(p, a, ((7 * p + 3 * i) % 11 - 5) / 10) for p in _PLACES for i, a in enumerate("ACDEFGHIKLMNPQRSTVWY")]
_CAND = "cand AS (SELECT DISTINCT run_id, line AS pos, substr('ACDEFGHIKLMNPQRSTVWY', 1 + CAST(CAST(depth AS BIGINT) % 20 AS INT), 1) AS amino FROM runs UNION SELECT run_id, line, substr('ACDEFGHIKLMNPQRSTVWY', 1 + CAST((run_id + line) % 20 AS INT), 1) FROM runs WHERE run_id % 3 = 0)"
_LOGISTIC = f"1 / (1 + exp(({summaries.RHO} - ({{s}})) * {summaries.A} + {summaries.B} - 0.5))"
_SUMMED = " ".join(f"JOIN z z{p} ON z{p}.run_id = z1.run_id AND z{p}.pos = {p}" for p in _PLACES if p > 1)


@query(
    "j11_matrix_score",
    f"WITH {_CAND}, w AS (SELECT run_id, c.pos, coalesce(CAST(weight AS DOUBLE), 0) AS x FROM cand c LEFT JOIN {values(_WEIGHTS, 'pos, amino, weight')} ON t.pos = c.pos AND t.amino = c.amino), k AS (SELECT DISTINCT run_id FROM w), z AS (SELECT run_id, pos, x FROM w UNION ALL SELECT run_id, p, 0 FROM k, (SELECT unnest(range(1, 8)) AS p) v WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.run_id = k.run_id AND w.pos = p)) SELECT z1.run_id, round(avg({_LOGISTIC.format(s=' + '.join(f'z{p}.x' for p in _PLACES))}), 6) AS score FROM z z1 {_SUMMED} WHERE z1.pos = 1 GROUP BY z1.run_id",
    "runs",
)
def j11(runs: DataFrame) -> DataFrame:
    """Lines are positions; a third of the runs are ambiguous in each."""
    letter = lambda n: F.substring(F.lit("ACDEFGHIKLMNPQRSTVWY"), (1 + n % 20).cast("int"), F.lit(1)).alias("amino")
    one = runs.select("run_id", F.col("line").alias("pos"), letter(F.col("depth").cast("long")))
    two = runs.filter("run_id % 3 = 0").select("run_id", F.col("line").alias("pos"), letter(F.col("run_id") + F.col("line")))
    weights = runs.sparkSession.createDataFrame(_WEIGHTS, "pos int, amino string, weight double")
    return summaries.matrix_score(one.union(two).distinct(), weights, "run_id").withColumn("score", F.round("score", 6))


@query(
    "a11_insertion_counts",
    f"""WITH {_INSERTS}, i2 AS (SELECT rname, i.ref_pos, i.qname, first(i.insert ORDER BY i.flag) AS insert FROM ins i JOIN (SELECT DISTINCT qname, flag, rname FROM sam) s ON s.qname = i.qname AND s.flag = i.flag GROUP BY ALL),
    e AS (SELECT rname, ref_pos, k AS i, substr(insert, CAST(k + 1 AS INT), 1) AS base FROM (SELECT *, unnest(range(0, length(insert))) AS k FROM i2) x), c AS (SELECT rname, ref_pos, i, base, count(*) AS n FROM e GROUP BY ALL), cov AS (SELECT rname, ref_pos, count(*) AS coverage FROM bases GROUP BY ALL)
    SELECT * FROM c UNION ALL SELECT h.rname, h.ref_pos, i, '-', coverage - have FROM (SELECT rname, ref_pos, i, sum(n)::BIGINT AS have FROM c GROUP BY ALL) h JOIN cov ON cov.rname = h.rname AND cov.ref_pos = h.ref_pos WHERE coverage > have""",
    "sam",
)
def a11(sam: DataFrame) -> DataFrame:
    inserts = cigar.insertions(tokens_of(inserting(sam)), KEY).withColumn("mate", F.col("flag"))
    coverage = cigar.coverage(cigar.counted_tokens(sam.filter("cigar <> '*'"), ["rname"]), ["rname"])
    return summaries.insertion_counts(inserts, coverage)


@query("a12_inserted_slices", "SELECT refname, s AS slice, CAST(sum(cnt) AS BIGINT) AS n FROM (SELECT refname, cnt, substr(seq, CAST(31 - off AS INT), 6) AS s FROM aligned WHERE off <= 30 AND off + length(seq) >= 36) WHERE NOT regexp_matches(s, '[n-]') GROUP BY ALL", "aligned")
def a12(aligned: DataFrame) -> DataFrame:
    return summaries.inserted_slices(aligned, 30, 36)


@query("a14_sample_summary", "SELECT sample, mapped, valid, x4, CASE WHEN valid = 0 THEN '' ELSE printf('%.2f', 100.0 * x4 / valid) END AS x4_pct, CASE WHEN valid = 0 OR valid < 500 OR 100.0 * valid / mapped < 75 THEN '' WHEN 100.0 * x4 / valid >= 2 THEN 'X4' ELSE 'R5' END AS final, printf('%.2f', CASE WHEN valid = 0 THEN 0.0 ELSE 100.0 * valid / mapped END) AS valid_pct FROM (SELECT sample, CAST(sum(d) AS BIGINT) AS mapped, CAST(coalesce(sum(d) FILTER (WHERE line < 6), 0) AS BIGINT) AS valid, CAST(coalesce(sum(d) FILTER (WHERE line < 6 AND concordance > 0.09), 0) AS BIGINT) AS x4 FROM (SELECT *, CAST(depth AS BIGINT) AS d FROM runs) GROUP BY sample)", "runs")
def a14(runs: DataFrame) -> DataFrame:
    rows = runs.select("sample", F.col("depth").cast("long").alias("count"), (F.col("line") < 6).alias("valid"), (F.col("concordance") > 0.09).alias("x4"))
    return summaries.sample_summary(rows, "sample", 500, 75.0)


@query("a43_agreement", f"WITH {_LONG}, b AS (SELECT refname AS dest, pos, first(base ORDER BY n DESC, base) AS expected FROM long WHERE base IN ('A', 'C', 'G', 'T') GROUP BY ALL) SELECT dest, refname, CAST(sum(CASE WHEN base = expected THEN n ELSE 0 END) AS BIGINT) AS agree, CAST(sum(CASE WHEN base <> expected THEN n ELSE 0 END) AS BIGINT) AS disagree FROM long JOIN b ON b.pos = long.pos WHERE base IN ('A', 'C', 'G', 'T') GROUP BY ALL", "aligned")
def a43(aligned: DataFrame) -> DataFrame:
    long = counts.position_bases(aligned)
    best = long.filter(F.col("base").isin("A", "C", "G", "T")).groupBy("refname", "pos").agg(F.min(F.struct((-F.col("n")).alias("n"), "base"))["base"].alias("expected"))
    return summaries.agreement(long, best.withColumnRenamed("refname", "dest"))


@query("a44_amplicon_lengths", "SELECT length(s) AS length, count(*) AS n FROM (SELECT unnest(string_split(letters, 'x')) AS s FROM seqs) WHERE s <> '' GROUP BY 1", "seqs")
def a44(seqs: DataFrame) -> DataFrame:
    return summaries.stretch_lengths(seqs, "letters")


_AREAS = [("r1", 1, 30), ("r2", 31, 60), ("r3", 61, 95)]


@query(
    "a45_region_concordance",
    f"WITH {_CONS}, b AS (SELECT refname, pos, coverage, base, CASE WHEN pos % 5 = 0 THEN 'C' ELSE 'a' END AS expected FROM cons WHERE cutoff = 'MAX'), j AS (SELECT *, coverage > 100 AS covered, base = expected AS same FROM b JOIN {values(_AREAS, 'region, st, en')} ON pos BETWEEN st AND en) SELECT refname, region, CASE WHEN count(*) FILTER (WHERE covered AND (same OR base <> '-')) > 0 THEN 100 * count(*) FILTER (WHERE covered AND same) / count(*) FILTER (WHERE covered AND (same OR base <> '-')) ELSE 0 END AS pct_concordance, 100 * count(*) FILTER (WHERE covered AND (same OR base <> '-')) / max(en - st + 1) AS pct_covered FROM j GROUP BY refname, region",
    "aligned",
)
def a45(aligned: DataFrame) -> DataFrame:
    bases = counts.consensus_bases(counts.position_bases(aligned), ("MAX",)).withColumn("expected", F.when(F.col("pos") % 5 == 0, "C").otherwise("a"))
    return summaries.region_concordance(bases, aligned.sparkSession.createDataFrame(_AREAS, "region string, start long, end long"))


@query("j13_contig_range", f"WITH {_LONG} SELECT refname, pos + 100 * CAST(substr(refname, 4) AS INT) AS ref_pos, base, n FROM long WHERE pos + 100 * CAST(substr(refname, 4) AS INT) BETWEEN 50 AND 250", "aligned")
def j13(aligned: DataFrame) -> DataFrame:
    """Contigs lie on the reference at hundreds."""
    long = counts.position_bases(aligned)
    shift = long.select("refname").distinct().withColumn("shift", 100 * F.substring("refname", 4, 1).cast("int"))
    placed = long.join(shift, "refname").withColumn("ref_pos", F.col("pos") + F.col("shift"))
    return placed.filter("ref_pos BETWEEN 50 AND 250").select("refname", "ref_pos", "base", "n")


@query("j31_region_failures", "SELECT DISTINCT seed, region FROM (SELECT concat(seed, '-', sample) AS seed, region, on_score FROM scores) s WHERE NOT EXISTS (SELECT 1 FROM scores x WHERE concat(x.seed, '-', x.sample) = s.seed AND x.on_score >= 3)", "scores")
def j31(scores: DataFrame) -> DataFrame:
    named = scores.withColumn("seed", F.concat("seed", F.lit("-"), "sample"))
    return summaries.region_failures(named.select("seed", "region").distinct(), named.filter("on_score >= 3"))


@query("j33_combined_names", "SELECT sample, seed, string_agg(DISTINCT r, '~' ORDER BY r) AS name FROM (SELECT sample, seed, concat(region, CASE WHEN region IN ('R1', 'R3') THEN '*' ELSE '' END) AS r FROM scores WHERE on_score = 4) GROUP BY ALL", "scores")
def j33(scores: DataFrame) -> DataFrame:
    return summaries.covered_region_names(scores.filter("on_score = 4"), ["R1", "R3"])


_HITS = "hits AS (SELECT concat(sample, '-', run_id % 40) AS contig, app AS ref, CAST(depth AS BIGINT) AS score, CAST(concordance AS DOUBLE) AS share, line AS st, 4 AS en, run_id, line, CAST(run_time AS DOUBLE) AS tie FROM runs)"


def hits_of(runs: DataFrame) -> DataFrame:
    return runs.select(F.concat("sample", F.lit("-"), F.col("run_id") % 40).alias("contig"), F.col("app").alias("ref"), F.col("depth").cast("long").alias("score"), F.col("concordance").cast("double").alias("share"), F.col("line").alias("start"), F.lit(4).alias("end"), "run_id", "line", F.col("run_time").cast("double").alias("tie"))


@query("t3_best_hits", f"WITH {_HITS} SELECT contig, ref, share * CASE WHEN st <= en THEN 1 ELSE -1 END AS match FROM (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY score DESC, run_id DESC, line DESC, tie DESC, ref DESC, share * CASE WHEN st <= en THEN 1 ELSE -1 END DESC) AS k FROM hits) WHERE k = 1", "runs")
def t3(runs: DataFrame) -> DataFrame:
    return summaries.best_hits(hits_of(runs), "contig", ["run_id", "line", "tie"])


@query("t4_group_references", f"WITH {_HITS} SELECT grp, first(ref ORDER BY total DESC, ref) AS ref FROM (SELECT left(ref, 1) AS grp, ref, sum(score) AS total FROM hits GROUP BY ALL) GROUP BY grp", "runs")
def t4(runs: DataFrame) -> DataFrame:
    hits = hits_of(runs)
    return summaries.group_references(hits, hits.select("ref", F.substring("ref", 1, 1).alias("grp")).distinct())


@query("r5_complete_genotypes", "SELECT g.sample, g.region, on_score FROM (SELECT DISTINCT sample, unnest(['R0', 'R1', 'R2', 'R3', 'R4', 'R5']) AS region FROM scores WHERE on_score = 4) g LEFT JOIN (SELECT sample, region, max(on_score) AS on_score FROM scores GROUP BY ALL) s ON s.sample = g.sample AND s.region = g.region", "scores")
def r5(scores: DataFrame) -> DataFrame:
    from readloom.operators.runs import filled

    reported = scores.filter("on_score = 4").select("sample").distinct()
    have = scores.groupBy("sample", "region").agg(F.max("on_score").alias("on_score")).join(reported, "sample", "left_semi")
    expected = reported.select("sample", F.explode(F.array(*(F.lit(f"R{i}") for i in range(6)))).alias("region"))
    return filled(have, expected, ["sample", "region"])


@query("r10_nucleotide_mutations", f"WITH {_WIDE} SELECT refname, pos, wt, var, round(n / coverage, 6) AS prevalence FROM (SELECT refname, pos, coverage, substr('ACGT', CAST(1 + pos % 4 AS INT), 1) AS wt, unnest(['A', 'C', 'G', 'T']) AS var, unnest([\"A\", \"C\", \"G\", \"T\"]) AS n FROM wide WHERE coverage > 0) WHERE var <> wt AND n / coverage >= 0.05", "aligned")
def r10(aligned: DataFrame) -> DataFrame:
    wild = F.substring(F.lit("ACGT"), (1 + F.col("pos") % 4).cast("int"), F.lit(1))
    return summaries.nucleotide_mutations(counts.pileup(counts.position_bases(aligned)), wild).withColumn("prevalence", F.round("prevalence", 6))


@query("w20_interval_coverage", "WITH e AS (SELECT ref, r_st AS pos, 1 AS d FROM spans UNION ALL SELECT ref, r_ei + 1, -1 FROM spans), c AS (SELECT ref, pos, sum(d) AS d FROM e GROUP BY ALL) SELECT ref, pos, CAST(sum(d) OVER (PARTITION BY ref ORDER BY pos) AS BIGINT) AS coverage FROM c", "spans")
def w20(spans: DataFrame) -> DataFrame:
    return summaries.interval_coverage(spans)


@query(
    "a18_cut_support",
    f"WITH {_PLACED}, cut AS (SELECT doc_id AS contig, length(seq) // 2 AS cut FROM seqs WHERE length(seq) >= 200), g AS (SELECT contig, cut, unnest(range(cut - 20, cut + 21)) AS pos FROM cut), c AS (SELECT g.contig, g.pos, coalesce(sum(n), 0) AS c FROM g LEFT JOIN placed p ON p.contig = g.contig AND g.pos BETWEEN p.start + 1 AND p.start + 60 GROUP BY ALL) SELECT contig, CAST(min(c) AS BIGINT) AS support FROM c WHERE contig IN (SELECT contig FROM placed) GROUP BY contig",
    "seqs",
    "pieces60",
)
def a18(seqs: DataFrame, pieces: DataFrame) -> DataFrame:
    placed, contigs = placed_of(seqs, pieces)
    cuts = seqs.filter("length(seq) >= 200").select(F.col("doc_id").alias("contig"), F.floor(F.length("seq") / 2).alias("cut"))
    return kmers.cut_support(kmers.coverage(placed, contigs, 60), cuts, 20)


@query(
    "a53_genome_coverage",
    f"""WITH {_TOKENS}, r AS (SELECT rname, CAST(pos + r0 + i AS BIGINT) AS ref_pos, op AS link FROM (SELECT *, unnest(range(0, len)) AS i FROM tokens WHERE op IN ('M', 'D')) x
    UNION ALL SELECT rname, CAST(pos + r0 - CASE WHEN q0 = 0 THEN len ELSE 0 END + i AS BIGINT), 'U' FROM (SELECT *, unnest(range(0, len)) AS i FROM tokens WHERE op = 'S') y UNION ALL SELECT rname, CAST(pos + r0 - 1 AS BIGINT), 'I' FROM tokens WHERE op = 'I'),
    c AS (SELECT rname, ref_pos, link, count(*) AS n FROM r GROUP BY ALL)
    SELECT *, CAST(coalesce(sum(n) FILTER (WHERE link IN ('M', 'D')) OVER (PARTITION BY rname, ref_pos), 0) AS BIGINT) AS coverage, CAST(coalesce(sum(n) FILTER (WHERE link = 'D') OVER (PARTITION BY rname, ref_pos), 0) AS BIGINT) AS dels FROM c""",
    "sam",
)
def a53(sam: DataFrame) -> DataFrame:
    return summaries.genome_coverage(cigar.counted_tokens(sam.filter("cigar <> '*'"), ["rname"]), weight="reads")


@query(
    "j22_compared_positions",
    "WITH p AS (SELECT a.ord, a.seq AS s1, b.seq AS s2 FROM aligned a JOIN aligned b ON b.ord = a.ord + 1), e AS (SELECT substr(s1, CAST(i AS INT), 1) AS a, substr(s2, CAST(i AS INT), 1) AS b FROM (SELECT *, unnest(range(1, greatest(length(s1), length(s2)) + 1)) AS i FROM p) x) SELECT CASE WHEN a = b THEN 'match' WHEN b IN ('-', '') THEN 'deletion' WHEN a IN ('-', '') THEN 'addition' ELSE 'mismatch' END AS kind, count(*) AS n FROM e GROUP BY 1",
    "aligned",
)
def j22(aligned: DataFrame) -> DataFrame:
    following = aligned.select((F.col("ord") - 1).alias("ord"), F.col("seq").alias("s2"))
    return summaries.compared_positions(aligned.select("ord", F.col("seq").alias("s1")).join(following, "ord"), "ord", "s1", "s2")


@query(
    "i2_stop_passes",
    """WITH c AS (SELECT sample, line AS pass, app AS ref, CAST(sum(depth) AS BIGINT) AS n FROM runs GROUP BY ALL), t AS (SELECT sample, CAST(sum(depth) AS BIGINT) AS reads FROM runs GROUP BY sample),
    j AS (SELECT coalesce(a.sample, b.sample) AS sample, coalesce(a.pass, b.pass + 1) AS pass, a.n, b.n AS was FROM c a FULL JOIN c b ON a.sample = b.sample AND a.ref = b.ref AND a.pass = b.pass + 1),
    p AS (SELECT sample, pass, bool_and(n IS NOT NULL AND was IS NOT NULL) AS same, bool_or(coalesce(n > was, true)) AS gained, sum(n) AS mapped FROM j WHERE (sample, pass) IN (SELECT sample, pass FROM c) GROUP BY ALL)
    SELECT t.sample, min(pass) AS stopped FROM t LEFT JOIN p ON p.sample = t.sample AND pass > 1 AND same AND (NOT gained OR mapped > 0.95 * reads OR pass >= 3) GROUP BY t.sample""",
    "runs",
)
def i2(runs: DataFrame) -> DataFrame:
    per = runs.groupBy("sample", F.col("line").alias("pass"), F.col("app").alias("ref")).agg(F.sum("depth").cast("long").alias("n"))
    return iterate.stop_passes(per, "sample", runs.groupBy("sample").agg(F.sum("depth").cast("long").alias("reads")))
