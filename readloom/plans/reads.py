"""Queries on reads, pairs, pileups and consensus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import cigar, seq
from readloom.functions.tables import CODONS, CUTOFFS, MIXTURES, mixture_codons, values
from readloom.operators import counts, pairing, ranks
from readloom.plans.registry import query
from readloom.plans.scalars import _RC, _TOKENS, KEY, tokens_of
from readloom.sources import alignments, files

_USABLE = "sam_ok AS (SELECT * FROM sam WHERE qname IN (SELECT qname FROM sam GROUP BY qname HAVING count(*) = 2 AND count(*) FILTER (WHERE cigar = '*') = 0 AND min(rname) = max(rname)))"
_MERGE = f"""{_TOKENS}, {_USABLE},
 lens AS (SELECT qname, flag, max(ref_pos) AS len, min(ref_pos) FILTER (WHERE base <> '-') AS fd FROM bases WHERE qname IN (SELECT qname FROM sam_ok) GROUP BY ALL),
 pairs AS (SELECT a.qname, a.len AS l1, b.len AS l2, CASE WHEN a.len <= b.len THEN 99 ELSE 147 END AS f1, CASE WHEN a.len <= b.len THEN 147 ELSE 99 END AS f2, CASE WHEN a.len <= b.len THEN b.fd ELSE a.fd END AS fd FROM lens a JOIN lens b ON a.qname = b.qname AND a.flag = 99 AND b.flag = 147),
 grid AS (SELECT *, unnest(range(1, greatest(l1, l2) + 1)) AS i FROM pairs),
 sides AS (SELECT g.qname, g.i, fd, g.i > least(l1, l2) AS past, CASE WHEN g.i > least(l1, l2) THEN '' ELSE coalesce(x.base, '-') END AS b1, CASE WHEN g.i > least(l1, l2) THEN -33 ELSE coalesce(x.q, 0) END AS q1, coalesce(y.base, '-') AS b2, coalesce(y.q, 0) AS q2
   FROM grid g LEFT JOIN bases x ON x.qname = g.qname AND x.flag = f1 AND x.ref_pos = g.i LEFT JOIN bases y ON y.qname = g.qname AND y.flag = f2 AND y.ref_pos = g.i),
 kept AS (SELECT *, CASE WHEN past OR (b1 <> b2 AND q2 - q1 >= 5) THEN b2 ELSE b1 END AS m FROM sides),
 merged AS (SELECT qname, string_agg(CASE WHEN past AND i < fd THEN 'n' WHEN m <> '-' AND ((b1 <> b2 AND abs(q2 - q1) < 5) OR greatest(q1, q2) <= 15) THEN 'N' ELSE m END, '' ORDER BY i) AS merged FROM kept GROUP BY qname)"""


@query("j1_pair_mates", "SELECT qname, min(pos) FILTER (WHERE mate = 1) AS pos1, min(pos) FILTER (WHERE mate = 2) AS pos2, count(*) AS n FROM sam GROUP BY qname HAVING count(*) FILTER (WHERE mate = 1) = 1", "sam")
def j1(sam: DataFrame) -> DataFrame:
    return pairing.pair_mates(sam, "qname", ["mate"], ["pos"]).select("qname", F.col("r1.pos").alias("pos1"), F.col("r2.pos").alias("pos2"), "n")


@query("j2_join_mates", "SELECT a.pair_id, a.seq, b.seq AS seq2 FROM reads a JOIN reads b ON a.pair_id = b.pair_id AND a.mate = 1 AND b.mate = 2", "reads")
def j2(reads: DataFrame) -> DataFrame:
    second = reads.filter("mate = 2").select("pair_id", "seq")
    first = reads.filter("mate = 1").join(second.select("pair_id"), "pair_id", "left_semi").select("pair_id", "seq")
    return pairing.join_mates(first, second, "pair_id")


@query("j3_pair_by_index", "SELECT a.pair_id, length(a.seq) AS len1, length(b.seq) AS len2 FROM reads a JOIN reads b ON a.pair_id = b.pair_id AND a.mate = 1 AND b.mate = 2", "reads")
def j3(reads: DataFrame) -> DataFrame:
    a, b = (reads.filter(F.col("mate") == m).select("pair_id", "seq") for m in (1, 2))
    return pairing.pair_by_index(a, b, "pair_id", strict=False).select("pair_id", F.length("r1.seq").alias("len1"), F.length("r2.seq").alias("len2"))


@query("j4_merge_mates", f"WITH {_MERGE} SELECT qname, merged FROM merged WHERE length(replace(merged, 'N', '')) * 2 >= 2 * length(merged) - length(trim(merged, '-'))", "sam")
def j4(sam: DataFrame) -> DataFrame:
    return pairing.merge_pairs(sam).filter("merged IS NOT NULL").select("qname", "merged")


@query(
    "a10_failed_pairs",
    f"""WITH {_MERGE}, p AS (SELECT qname, count(*) AS n, count(*) FILTER (WHERE cigar = '*') AS stars, min(rname) AS r1, max(rname) AS r2 FROM sam GROUP BY qname),
    c AS (SELECT p.qname, CASE WHEN n = 1 THEN 'unmatched' WHEN stars > 0 THEN 'badCigar' WHEN r1 <> r2 THEN '2refs' WHEN 2 * (length(merged) - length(replace(merged, 'N', ''))) > length(trim(merged, '-')) THEN 'manyNs' END AS cause FROM p LEFT JOIN merged m ON p.qname = m.qname)
    SELECT * FROM c WHERE cause IS NOT NULL""",
    "sam",
)
def a10(sam: DataFrame) -> DataFrame:
    return pairing.merge_pairs(sam).filter("cause IS NOT NULL").select("qname", "cause")


_INSERTS = f"{_TOKENS}, ins AS (SELECT qname, flag, CAST(pos + r0 - 1 AS BIGINT) AS ref_pos, substr(seq, q0 + 1, len) AS insert, substr(qual, q0 + 1, len) AS insert_qual FROM tokens WHERE op = 'I')"


@query(
    "j5_merge_insertions",
    f"""WITH {_INSERTS}, good AS (SELECT * FROM ins WHERE list_min(list_transform(string_split(insert_qual, ''), lambda c: ascii(c) - 33)) > 15)
    SELECT coalesce(a.qname, b.qname) AS qname, coalesce(a.ref_pos, b.ref_pos) AS ref_pos, coalesce(a.insert, b.insert) AS merged
    FROM (SELECT * FROM good WHERE flag = 99) a FULL JOIN (SELECT * FROM good WHERE flag = 147) b ON a.qname = b.qname AND a.ref_pos = b.ref_pos""",
    "sam",
)
def j5(sam: DataFrame) -> DataFrame:
    found = cigar.insertions(tokens_of(sam), KEY).withColumn("mate", F.when(F.col("flag") == 99, 1).otherwise(2))
    return pairing.merge_insertions(found)


@query(
    "a9_soft_clips",
    f"""WITH {_TOKENS}, {_USABLE}, clips AS (SELECT DISTINCT qname, rname, CAST(pos + r0 - CASE WHEN q0 = 0 THEN len ELSE 0 END + i AS BIGINT) AS ref_pos FROM (SELECT *, unnest(range(0, len)) AS i FROM tokens WHERE op = 'S') x)
    SELECT rname, ref_pos, count(*) AS n FROM clips c WHERE qname IN (SELECT qname FROM sam_ok) AND NOT EXISTS (SELECT 1 FROM bases b WHERE b.qname = c.qname AND b.ref_pos = c.ref_pos AND b.q >= 0) GROUP BY ALL""",
    "sam",
)
def a9(sam: DataFrame) -> DataFrame:
    return pairing.clip_counts(sam)


@query(
    "t5_mixed_references",
    "WITH s AS (SELECT *, CASE WHEN mapq % 5 <> 4 THEN CAST(length(replace(seq, 'T', '')) - pos % 7 AS INT) END AS score FROM sam WHERE flag & 4 = 0) SELECT qname, rname, mapq, score FROM (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY mapq DESC, score DESC NULLS LAST, mate) AS k FROM s WHERE qname IN (SELECT qname FROM s GROUP BY qname HAVING count(DISTINCT rname) > 1)) WHERE k = 1",
    "sam",
)
def t5(sam: DataFrame) -> DataFrame:
    """Alignments are written with their scores as tags, but for some, and read back."""
    path = files.scratch(sam.sparkSession)
    scored = sam.withColumn("score", F.when(F.col("mapq") % 5 != 4, F.length(F.translate("seq", "T", "")) - F.col("pos") % 7).cast("int"))
    files.write_sam(scored.withColumns({"rnext": F.lit("="), "pnext": F.lit(0), "tlen": F.lit(0)}), path)
    tagged = files.read_sam(sam.sparkSession, path)
    return pairing.resolve_mixed_references(tagged.withColumn("mate", F.when(cigar.is_first(F.col("flag")), 1).otherwise(2)))


@query(
    "j24_read_movement",
    """WITH b AS (SELECT qname, mate, CASE WHEN flag & 4 <> 0 THEN '*' ELSE concat(rname, ':', CAST(floor(pos / 10) AS BIGINT)) END AS s, CASE WHEN flag & 4 <> 0 OR pair_id % 11 = 0 THEN '*' ELSE concat(rname, ':', CAST(floor((pos + pair_id % 30) / 10) AS BIGINT)) END AS t FROM sam),
    c AS (SELECT s AS source, t AS target, count(*) AS n FROM b GROUP BY ALL), w AS (SELECT *, n / sum(n) OVER (PARTITION BY source) AS share FROM c) SELECT source, target, n FROM w WHERE share >= 0.1""",
    "sam",
)
def j24(sam: DataFrame) -> DataFrame:
    moved = sam.withColumns({"pos": F.col("pos") + F.col("pair_id") % 30, "flag": F.when(F.col("pair_id") % 11 == 0, 4).otherwise(F.col("flag"))})
    return pairing.read_movement(sam, moved, width=10)


_BAD = "bad AS (SELECT tile, cycle, errorrate, bool_or(errorrate IS NULL OR errorrate >= 7.5) OVER (PARTITION BY tile, cycle < 0 ORDER BY abs(cycle) ROWS UNBOUNDED PRECEDING) AS bad FROM quality)"


@query(
    "p9_censor_bases",
    """WITH bad AS (SELECT DISTINCT 1101 + tile % 7 AS tile, CASE WHEN mate = 2 THEN -c ELSE c END AS cycle FROM (SELECT tile, mate, unnest([1 + tile % 5, 20 + tile % 7]) AS c FROM (SELECT DISTINCT pair_id % 7 AS tile, mate FROM reads)) x),
    each AS (SELECT pair_id, mate, r.tile, i, CASE WHEN b.tile IS NULL THEN substr(seq, CAST(i AS INT), 1) ELSE 'N' END AS s, CASE WHEN b.tile IS NULL THEN substr(qual, CAST(i AS INT), 1) ELSE '#' END AS q
      FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM reads) r LEFT JOIN bad b ON b.tile = r.tile AND b.cycle = CASE WHEN mate = 1 THEN i ELSE -i END)
    SELECT pair_id, mate, string_agg(s, '' ORDER BY i) AS seq, string_agg(q, '' ORDER BY i) AS qual FROM each GROUP BY pair_id, mate""",
    "reads",
)
def p9(reads: DataFrame) -> DataFrame:
    tiles = reads.select((F.col("pair_id") % 7).alias("k"), "mate").distinct()
    cycle = F.explode(F.array(1 + F.col("k") % 5, 20 + F.col("k") % 7))
    bad = tiles.select((1101 + F.col("k") % 7).alias("tile"), "mate", cycle.alias("c")).select("tile", F.when(F.col("mate") == 2, -F.col("c")).otherwise(F.col("c")).alias("cycle")).distinct()
    return pairing.censored(reads, bad).select("pair_id", "mate", "seq", "qual")


@query(
    "p10_cut_primers",
    "SELECT pair_id, mate, seq FROM (SELECT *, min(length(seq)) OVER (PARTITION BY pair_id) AS least FROM (SELECT pair_id, mate, substr(seq, 1 + CASE WHEN pair_id % 3 = 0 THEN 20 ELSE 0 END, greatest(0, length(seq) - CASE WHEN pair_id % 3 = 0 THEN 20 ELSE 0 END - CASE WHEN tile % 2 = 0 THEN 15 ELSE 0 END)) AS seq FROM reads)) WHERE least > 0",
    "reads",
)
def p10(reads: DataFrame) -> DataFrame:
    starts = reads.filter("pair_id % 3 = 0").select("pair_id", "mate", F.lit(20).alias("start_len"))
    ends = reads.filter("tile % 2 = 0").select("pair_id", "mate", F.lit(15).alias("end_len"))
    return pairing.cut_primers(reads.select("pair_id", "mate", "seq"), starts, ends)


@query("t10_sampled_pairs", "SELECT pair_id, mate, seq FROM reads WHERE pair_id % 10 < 3", "reads")
def t10(reads: DataFrame) -> DataFrame:
    return pairing.kept_pairs(reads, "pair_id", 3, 10).select("pair_id", "mate", "seq")


@query("t8_reads_in_region", f"WITH {_TOKENS} SELECT qname, flag FROM bases WHERE rname = 'ref1' GROUP BY qname, flag HAVING min(ref_pos) <= 40 AND max(ref_pos) >= 30", "sam")
def t8(sam: DataFrame) -> DataFrame:
    path = files.scratch(sam.sparkSession)
    alignments.write_clustered(sam, path)
    return alignments.reads_in_region(sam.sparkSession, path, "ref1", 30, 40).select("qname", "flag").orderBy("qname")


@query("t7_coordinate_sort", "SELECT rname, pos, qname, row_number() OVER (PARTITION BY rname ORDER BY pos, qname, mate) AS place FROM sam WHERE flag & 4 = 0", "sam")
def t7(sam: DataFrame) -> DataFrame:
    """Reads as they lie in sorted files, with their places on their references."""
    path = files.scratch(sam.sparkSession)
    alignments.write_clustered(sam, path)
    mapped = sam.sparkSession.read.parquet(path).filter("flag & 4 = 0").select("rname", "pos", "qname", "mate")
    return ranks.numbered(mapped, ["rname"], ["pos", "qname", "mate"], "place").select("rname", "pos", "qname", (F.col("place") + 1).alias("place"))


@query("a26_stage_counts", "SELECT rname, count(*) AS n, count(*) FILTER (WHERE mapq > 41) AS filtered FROM sam GROUP BY rname", "sam")
def a26(sam: DataFrame) -> DataFrame:
    return sam.groupBy("rname").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("mapq") > 41).alias("filtered"))


@query("t2_best_reference", "SELECT grp, rname, n FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY n DESC, rname) AS k FROM (SELECT substr(rname, 4, 1) IN ('0', '1') AS grp, rname, count(*) AS n FROM sam WHERE flag & 4 = 0 AND mapq > 41 GROUP BY ALL) WHERE n >= 3) WHERE k = 1", "sam")
def t2(sam: DataFrame) -> DataFrame:
    group = F.substring("rname", 4, 1).isin("0", "1").alias("grp")
    n = sam.filter("flag & 4 = 0 AND mapq > 41").groupBy(group, "rname").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")
    return counts.ranked(n, ["grp"], [F.desc("n"), "rname"]).filter("rank = 0").select("grp", "rname", "n")


@query("a13_read_counts", "SELECT tile, seq, count(*) AS n FROM reads GROUP BY ALL", "reads")
def a13(reads: DataFrame) -> DataFrame:
    return counts.read_counts(reads, ["tile", "seq"])


@query("a15_canonical_counts", f"SELECT length(seq) AS len, least(seq, {_RC.format('seq')}) AS canonical, count(*) AS n FROM reads GROUP BY ALL", "reads")
def a15(reads: DataFrame) -> DataFrame:
    return counts.canonical_counts(reads)


@query("t1_top_reads", "WITH c AS (SELECT seq, count(*) AS n FROM reads GROUP BY seq) SELECT seq, n FROM c WHERE n >= 2 UNION ALL SELECT NULL, CAST(sum(n) AS BIGINT) FROM c WHERE n < 2 HAVING count(*) > 0", "reads")
def t1(reads: DataFrame) -> DataFrame:
    return counts.top_counts(counts.read_counts(reads, ["seq"]), 2)


@query("a30_read_quality", "SELECT tile, mate, CAST(sum(length(qual)) AS BIGINT) AS bases, round(sum(list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33))) / sum(length(qual)), 6) AS quality FROM reads GROUP BY ALL", "reads")
def a30(reads: DataFrame) -> DataFrame:
    total = F.aggregate(F.transform(F.filter(F.split("qual", ""), lambda c: c != ""), cigar.phred), F.lit(0), lambda a, x: a + x)
    return reads.groupBy("tile", "mate").agg(F.sum(F.length("qual")).alias("bases"), F.round(F.sum(total) / F.sum(F.length("qual")), 6).alias("quality"))


_LONG = "long AS (SELECT refname, CAST(off + i AS BIGINT) AS pos, substr(seq, CAST(i AS INT), 1) AS base, CAST(sum(cnt) AS BIGINT) AS n FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM aligned) x WHERE substr(seq, CAST(i AS INT), 1) <> 'n' GROUP BY ALL)"
_WIDE = f"{_LONG}, wide AS (SELECT refname, pos, {', '.join(f'''CAST(coalesce(sum(n) FILTER (WHERE base = '{b}'), 0) AS BIGINT) AS "{'del' if b == '-' else b}"''' for b in counts.BASES)}, CAST(coalesce(sum(n) FILTER (WHERE base <> 'N'), 0) AS BIGINT) AS coverage FROM long GROUP BY refname, pos)"


@query("a1_pileup", f"WITH {_WIDE} SELECT * FROM wide", "aligned")
def a1(aligned: DataFrame) -> DataFrame:
    return counts.pileup(counts.position_bases(aligned))


_CONS = f"""{_LONG}, cov AS (SELECT *, coalesce(sum(n) FILTER (WHERE base <> 'N') OVER (PARTITION BY refname, pos), 0) AS coverage, max(n) FILTER (WHERE base <> 'N') OVER (PARTITION BY refname, pos) AS most FROM long),
 cut AS (SELECT * FROM cov, (VALUES {', '.join(f"('{c}')" for c in CUTOFFS)}) c(cutoff)),
 mix AS (SELECT refname, pos, cutoff, coverage, coalesce(string_agg(base, '' ORDER BY base) FILTER (WHERE base NOT IN ('N', '-') AND n >= CASE WHEN cutoff = 'MAX' THEN most ELSE coverage * TRY_CAST(cutoff AS DOUBLE) END), '') AS bases,
   coalesce(bool_or(base = '-' AND n >= CASE WHEN cutoff = 'MAX' THEN most ELSE coverage * TRY_CAST(cutoff AS DOUBLE) END), false) AS deleted FROM cut GROUP BY ALL),
 cons AS (SELECT refname, pos, cutoff, CAST(coverage AS BIGINT) AS coverage, CASE WHEN deleted THEN lower(coalesce(code, '-')) ELSE coalesce(code, 'N') END AS base FROM mix LEFT JOIN (SELECT * FROM {values(list(MIXTURES.items()), 'bases, code')}) t ON mix.bases = t.bases)"""


@query("a6_consensus_bases", f"WITH {_CONS} SELECT * FROM cons", "aligned")
def a6(aligned: DataFrame) -> DataFrame:
    return counts.consensus_bases(counts.position_bases(aligned))


@query(
    "a7_consensus_sequences",
    f"""WITH {_CONS}, t AS (SELECT *, CASE WHEN coverage < 100 THEN 'x' WHEN base = '-' THEN '' ELSE base END AS b FROM cons), f AS (SELECT refname, cutoff, min(pos) AS first FROM t WHERE b NOT IN ('x', '') GROUP BY ALL)
    SELECT t.refname, t.cutoff, first - 1 AS seed_offset, rtrim(string_agg(b, '' ORDER BY pos), 'x') AS sequence FROM t JOIN f ON t.refname = f.refname AND t.cutoff = f.cutoff AND pos >= first GROUP BY ALL""",
    "aligned",
)
def a7(aligned: DataFrame) -> DataFrame:
    return counts.consensus_sequences(counts.consensus_bases(counts.position_bases(aligned), discard_deletions=True))


_CODONS = """framed AS (SELECT refname, cnt, off + frame AS start, frame, concat(repeat(' ', CAST((off + frame) % 3 AS INT)), seq) AS p FROM aligned, (VALUES (0), (1), (2)) f(frame)),
 filled AS (SELECT *, rpad(p, CAST(ceil(length(p) / 3) * 3 AS INT), ' ') AS w FROM framed),
 codons AS (SELECT refname, frame, CAST(floor(start / 3) AS BIGINT) + i AS codon_idx, substr(w, CAST(3 * i + 1 AS INT), 3) AS codon, CAST(sum(cnt) AS BIGINT) AS n FROM (SELECT *, unnest(range(0, length(w) // 3)) AS i FROM filled) x GROUP BY ALL)"""
_AMINOS = f"""{_CODONS}, kinds AS (SELECT *, CASE WHEN contains(codon, 'N') THEN 'low_quality' WHEN codon = '---' THEN 'del' WHEN contains(codon, '-') THEN 'partial' WHEN contains(codon, ' ') OR contains(codon, 'n') THEN NULL ELSE 'amino' END AS kind FROM codons),
 amino_rows AS (SELECT refname, frame, codon_idx, CASE WHEN kind = 'amino' THEN coalesce(t.amino, '?') ELSE kind END AS amino, CAST(sum(n) AS BIGINT) AS n FROM kinds k LEFT JOIN (SELECT * FROM {values(list(CODONS.items()), 'codon, amino')}) t ON t.codon = k.codon WHERE kind IS NOT NULL GROUP BY ALL)"""


@query("a2_codon_counts", f"WITH {_CODONS} SELECT * FROM codons", "aligned")
def a2(aligned: DataFrame) -> DataFrame:
    return counts.codon_counts(aligned)


@query("a3_amino_counts", f"WITH {_AMINOS} SELECT * FROM amino_rows", "aligned")
def a3(aligned: DataFrame) -> DataFrame:
    return counts.amino_counts(counts.codon_counts(aligned))


@query(
    "a4_combined_counts",
    f"WITH {_WIDE}, two AS (SELECT pos, pos AS idx, coverage, \"A\" FROM wide WHERE refname = 'ref0' UNION ALL SELECT pos, pos + CAST(pos % 4 = 0 AS INT), coverage, \"A\" FROM wide WHERE refname = 'ref1') SELECT pos, CASE WHEN count(DISTINCT idx) = 1 THEN max(idx) END AS idx, CAST(sum(coverage) AS BIGINT) AS coverage, CAST(sum(\"A\") AS BIGINT) AS \"A\" FROM two GROUP BY pos",
    "aligned",
)
def a4(aligned: DataFrame) -> DataFrame:
    wide = counts.pileup(counts.position_bases(aligned))
    one = wide.filter("refname = 'ref0'").select("pos", F.col("pos").alias("idx"), "coverage", "A")
    two = wide.filter("refname = 'ref1'").select("pos", (F.col("pos") + (F.col("pos") % 4 == 0).cast("int")).alias("idx"), "coverage", "A")
    return counts.combined(one, two, ["pos"], "idx", ["coverage", "A"])


@query("a5_overlap_counts", f"WITH {_WIDE} SELECT refname, CAST(floor((pos - 1) / 3) AS BIGINT) AS codon_idx, max(\"A\" + \"C\" + \"G\" + \"T\") AS v3_overlap FROM wide GROUP BY ALL", "aligned")
def a5(aligned: DataFrame) -> DataFrame:
    long = counts.position_bases(aligned)
    return counts.overlaps(long, long)


@query(
    "a41_base_shares",
    f"WITH {_LONG}, g AS (SELECT refname, pos, base, sum(n) AS n, grouping(refname) AS a FROM long GROUP BY GROUPING SETS ((refname, pos, base), (pos, base))), s AS (SELECT *, round(100 * n / sum(n) OVER (PARTITION BY a, refname, pos), 2) AS share FROM g) SELECT refname, s.pos, base, share FROM s JOIN (SELECT pos, count(DISTINCT refname) AS c FROM long GROUP BY pos) c ON c.pos = s.pos WHERE share > 0 AND (a = 0 OR c > 1)",
    "aligned",
)
def a41(aligned: DataFrame) -> DataFrame:
    return counts.shares(counts.position_bases(aligned))


@query("a50_majority", f"WITH {_LONG}, b AS (SELECT refname, pos, first(base ORDER BY n DESC, base) AS b FROM long WHERE base IN ('A', 'C', 'G', 'T') GROUP BY ALL), d AS (SELECT refname, unnest(range(1, max(pos) + 1)) AS pos FROM b GROUP BY refname) SELECT d.refname, string_agg(coalesce(b, 'N'), '' ORDER BY d.pos) AS sequence FROM d LEFT JOIN b ON b.refname = d.refname AND b.pos = d.pos GROUP BY d.refname", "aligned")
def a50(aligned: DataFrame) -> DataFrame:
    return counts.majority_bases(counts.position_bases(aligned))


@query("a51_depths", f"WITH {_WIDE} SELECT refname, max(coverage - \"del\") AS depth FROM wide GROUP BY refname", "aligned")
def a51(aligned: DataFrame) -> DataFrame:
    wide = counts.pileup(counts.position_bases(aligned))
    return wide.groupBy("refname").agg(F.max(F.col("coverage") - F.col("del")).alias("depth")).orderBy(F.desc("depth"), "refname")


@query("w2_ranked_reads", "SELECT refname, qcut, ord, row_number() OVER (PARTITION BY refname, qcut ORDER BY ord) - 1 AS rank FROM aligned", "aligned")
def w2(aligned: DataFrame) -> DataFrame:
    return ranks.numbered(aligned.select("refname", "qcut", "ord"), ["refname", "qcut"], ["ord"], "rank")


@query("c3_report_consensus", f"WITH {_CONS} SELECT refname, pos, concat(CASE WHEN coverage < 100 THEN 'x' ELSE base END, CASE WHEN pos % 9 = 0 THEN 'i' ELSE '' END) AS base FROM cons WHERE cutoff = 'MAX'", "aligned")
def c3(aligned: DataFrame) -> DataFrame:
    """With insertions at each ninth position, for want of insertion counts in the lens."""
    bases = counts.consensus_bases(counts.position_bases(aligned), ("MAX",))
    text = F.when(F.col("coverage") < 100, "x").otherwise(F.col("base"))
    return bases.select("refname", "pos", F.concat(text, F.when(F.col("pos") % 9 == 0, "i").otherwise("")).alias("base"))


@query(
    "p20_call_errors",
    f"""WITH codons AS (SELECT * FROM {values(mixture_codons(), 'codon, aminos')}), s AS (SELECT pair_id, mate, CASE WHEN pair_id % 4 = 0 THEN concat('TGT', seq, 'TGT') ELSE seq END AS seq FROM reads),
    e AS (SELECT pair_id, mate, seq, i, substr(seq, CAST(3 * i + 1 AS INT), 3) AS codon FROM (SELECT *, unnest(range(0, length(seq) // 3)) AS i FROM s) x),
    t AS (SELECT pair_id, mate, string_agg(CASE WHEN length(aminos) = 1 THEN aminos ELSE 'X' END, '' ORDER BY i) AS prot, count(*) FILTER (WHERE length(aminos) > 1) AS amb, max(length(aminos)) AS most FROM e JOIN codons c ON c.codon = e.codon GROUP BY pair_id, mate),
    p AS (SELECT s.pair_id, s.mate, seq, coalesce(prot, '') AS prot, coalesce(amb, 0) AS amb, coalesce(most, 0) AS most FROM s LEFT JOIN t ON t.pair_id = s.pair_id AND t.mate = s.mate)
    SELECT pair_id, mate, CASE WHEN 2 * (length(seq) - length(replace(seq, 'N', ''))) > length(seq) THEN 'low quality' WHEN length(seq) = 0 THEN 'zerolength' WHEN length(seq) % 3 <> 0 THEN 'notdiv3' WHEN left(prot, 1) <> 'C' OR right(prot, 1) <> 'C' THEN 'cysteines' WHEN amb > 1 OR most > 2 THEN '> 2 ambiguous' WHEN contains(prot, '*') THEN 'stop codons' WHEN length(prot) < 32 OR length(prot) > 40 THEN 'length' END AS error FROM p""",
    "reads",
)
def p20(reads: DataFrame) -> DataFrame:
    made = reads.select("pair_id", "mate", F.when(F.col("pair_id") % 4 == 0, F.concat(F.lit("TGT"), "seq", F.lit("TGT"))).otherwise(F.col("seq")).alias("seq"))
    return seq.translate(made).select("pair_id", "mate", seq.call_error().alias("error"))
