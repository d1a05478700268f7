"""Queries of remapping, attached counts, segment concordance, matches, cover removal and the k-mer spectrum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import cigar
from readloom.functions.tables import values
from readloom.operators import counts, intervals, kmers, pairing, segments
from readloom.plans.reads import _INSERTS, _LONG, _MERGE, _USABLE
from readloom.plans.registry import query
from readloom.plans.scalars import _TOKENS, KEY, inserting, tokens_of
from readloom.sources import files

_REMAP = f"""{_MERGE}, ins AS (SELECT qname, flag, CAST(pos + r0 - 1 AS BIGINT) AS ref_pos, substr(seq, q0 + 1, len) AS insert, substr(qual, q0 + 1, len) AS insert_qual FROM tokens WHERE op = 'I'),
 good AS (SELECT * FROM ins WHERE list_min(list_transform(string_split(insert_qual, ''), lambda c: ascii(c) - 33)) > 15),
 one_ref AS (SELECT qname, min(rname) AS rname, count(*) FILTER (WHERE flag & 4 = 0) AS mapped FROM sam GROUP BY qname HAVING min(rname) = max(rname)),
 letters AS (SELECT o.rname, o.qname, i AS pos, substr(merged, CAST(i AS INT), 1) AS ch FROM (SELECT *, unnest(range(length(merged) - length(ltrim(merged, '-')) + 1, length(merged) + 1)) AS i FROM merged) m JOIN one_ref o ON o.qname = m.qname WHERE mapped = 2
  UNION ALL SELECT o.rname, o.qname, ref_pos, CASE WHEN base <> '-' AND q <= 15 THEN 'N' ELSE base END FROM bases b JOIN one_ref o ON o.qname = b.qname WHERE mapped = 1),
 merged_ins AS (SELECT coalesce(a.qname, b.qname) AS qname, coalesce(a.ref_pos, b.ref_pos) AS ref_pos, coalesce(a.insert, b.insert) AS insert FROM (SELECT * FROM good WHERE flag = 99) a FULL JOIN (SELECT * FROM good WHERE flag = 147) b ON a.qname = b.qname AND a.ref_pos = b.ref_pos),
 held AS (SELECT l.rname, l.pos, l.ch AS base, m.insert FROM merged_ins m JOIN letters l ON l.qname = m.qname AND l.pos = m.ref_pos WHERE length(m.insert) % 3 = 0 AND l.ch NOT IN ('n', 'N', '-')),
 each AS (SELECT rname, pos, ch AS token, 1 AS n FROM letters WHERE ch <> 'n' UNION ALL SELECT rname, pos, concat(base, insert), 1 FROM held UNION ALL SELECT rname, pos, base, -1 FROM held),
 counted AS (SELECT rname, pos, token, sum(n) AS n FROM each GROUP BY ALL HAVING sum(n) > 0)"""


@query(
    "a8_remap_consensus",
    f"""WITH {_REMAP}, best AS (SELECT rname, pos, first(token ORDER BY n DESC, token) FILTER (WHERE token NOT IN ('N', '-')) AS token, bool_or(token = 'N') AS unsure FROM counted GROUP BY ALL),
    dense AS (SELECT rname, unnest(range(1, max(pos) + 1)) AS pos FROM best GROUP BY rname HAVING count(token) > 0),
    placed AS (SELECT d.rname, d.pos, token, token IS NULL AND unsure IS NOT NULL AND NOT unsure AS deleted FROM dense d LEFT JOIN best b ON b.rname = d.rname AND b.pos = d.pos),
    runs AS (SELECT *, count(*) FILTER (WHERE deleted) OVER (PARTITION BY rname ORDER BY pos) AS dashes, count(token) OVER (PARTITION BY rname ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS called FROM placed),
    pend AS (SELECT *, count(*) FILTER (WHERE deleted) OVER (PARTITION BY rname, called) AS pending FROM runs)
    SELECT rname, string_agg(CASE WHEN token IS NOT NULL THEN concat(CASE WHEN pending % 3 <> 0 THEN repeat('-', pending) ELSE '' END, token) WHEN deleted THEN '' ELSE 'N' END, '' ORDER BY pos) AS sequence FROM pend GROUP BY rname""",
    "sam",
)
def a8(sam: DataFrame) -> DataFrame:
    """A pair counts once where its mates overlap; reads whose mate is unmapped count alone."""
    path = files.scratch(sam.sparkSession)
    pairing.mapped_texts(sam).write.parquet(path)
    texts = sam.sparkSession.read.parquet(path)
    found = cigar.insertions(tokens_of(inserting(sam)), KEY).withColumn("mate", F.when(F.col("flag") == 99, 1).otherwise(2))
    return segments.remap_consensus(segments.remap_tokens(*segments.merged_bases(texts, pairing.merge_insertions(found))))


_GENES = [("g1", 1, 30), ("g2", 28, 60), ("g3", 61, 79)]


@query(
    "j12_attached_counts",
    f"""WITH {_INSERTS}, {_USABLE}, {_LONG},
    clips AS (SELECT rname, ref_pos, count(*) AS n FROM (SELECT DISTINCT qname, rname, CAST(pos + r0 - CASE WHEN q0 = 0 THEN len ELSE 0 END + i AS BIGINT) AS ref_pos FROM (SELECT *, unnest(range(0, len)) AS i FROM tokens WHERE op = 'S') x) c WHERE qname IN (SELECT qname FROM sam_ok) AND NOT EXISTS (SELECT 1 FROM bases b WHERE b.qname = c.qname AND b.ref_pos = c.ref_pos AND b.q >= 0) GROUP BY ALL),
    inserted AS (SELECT rname, ref_pos, count(DISTINCT qname) AS n FROM ins JOIN (SELECT DISTINCT qname, flag, rname FROM sam) s USING (qname, flag) GROUP BY ALL),
    cov AS (SELECT refname, pos, sum(n) FILTER (WHERE base <> '-') AS n, sum(n) AS al FROM long GROUP BY ALL),
    report AS (SELECT r.refname AS seed, region, p AS pos, CASE WHEN c.n >= 0.9 * c.al AND p % 11 <> 3 THEN st + p - 2 END AS idx FROM (SELECT DISTINCT refname FROM cov) r, (SELECT *, unnest(range(1, en - st + 2)) AS p FROM {values(_GENES, 'region, st, en')}) g LEFT JOIN cov c ON c.refname = r.refname AND c.pos = st + p - 1),
    lined AS (SELECT *, row_number() OVER w AS i FROM report WINDOW w AS (PARTITION BY seed, region ORDER BY pos)),
    ends AS (SELECT seed, region, arg_min(i, i) AS ia, arg_min(idx, i) AS xa, arg_max(i, i) AS ib, arg_max(idx, i) AS xb FROM lined WHERE idx IS NOT NULL GROUP BY ALL),
    q AS (SELECT l.*, CAST(1 + CASE WHEN i < ia THEN i - ia + xa WHEN i > ib THEN i - ib + xb ELSE idx END AS BIGINT) AS query_pos FROM lined l LEFT JOIN ends e ON e.seed = l.seed AND e.region = l.region)
    SELECT q.seed, q.region, q.pos, q.idx, query_pos, CASE WHEN query_pos IS NOT NULL THEN coalesce(c.n, 0) END AS clip_count, CASE WHEN query_pos IS NOT NULL THEN coalesce(n.n, 0) + coalesce(o.n, 0) END AS insertion_count
    FROM q LEFT JOIN clips c ON c.rname = q.seed AND c.ref_pos = query_pos LEFT JOIN inserted n ON n.rname = q.seed AND n.ref_pos = query_pos LEFT JOIN (SELECT rname, ref_pos, n FROM inserted WHERE n % 2 = 0) o ON o.rname = q.seed AND q.region = 'g2' AND o.ref_pos = q.pos""",
    "sam", "aligned",
)
def j12(sam: DataFrame, aligned: DataFrame) -> DataFrame:
    """Positions of three regions with the pileup of the reads; some have no index, as where a consensus has a gap."""
    long = counts.position_bases(aligned)
    cov = long.groupBy("refname", "pos").agg(F.sum(F.when(F.col("base") != "-", F.col("n"))).alias("n"), F.sum("n").alias("al"))
    genes = sam.sparkSession.createDataFrame(_GENES, "region string, st long, en long").select("region", "st", F.explode(F.sequence(F.lit(1).cast("long"), F.col("en") - F.col("st") + 1)).alias("p"))
    wanted = long.select("refname").distinct().crossJoin(F.broadcast(genes)).withColumn("pos", F.col("st") + F.col("p") - 1)  # a fixed list
    idx = F.when((F.col("n") >= 0.9 * F.col("al")) & (F.col("p") % 11 != 3), F.col("st") + F.col("p") - 2)
    report = wanted.join(cov, ["refname", "pos"], "left").select(F.col("refname").alias("seed"), "region", F.col("p").alias("pos"), idx.alias("idx"))
    clips = pairing.clip_counts(sam).toDF("seed", "query_pos", "n")
    inserted = cigar.insertions(tokens_of(inserting(sam)), KEY).groupBy("rname", "ref_pos").agg(F.count_distinct("qname").alias("n"))
    own = inserted.filter("n % 2 = 0").select(F.col("rname").alias("seed"), F.lit("g2").alias("region"), F.col("ref_pos").alias("pos"), "n")
    return segments.attached_counts(report, clips, inserted.toDF("seed", "query_pos", "n"), own)


_AREAS = [("r1", 1, 26), ("r2", 20, 61), ("r3", 61, 96)]


@query(
    "a46_seed_concordance",
    f"""WITH {_TOKENS}, m AS (SELECT * FROM bases WHERE base <> '-'), seed AS (SELECT rname, ref_pos, first(base ORDER BY n DESC, base) AS expected FROM (SELECT rname, ref_pos, base, count(*) AS n FROM m GROUP BY ALL) GROUP BY ALL),
    met AS (SELECT (CAST(substr(qname, 2) AS BIGINT)) // 65536 AS contig, m.rname, region, st, en, m.ref_pos, max(CASE WHEN base = expected THEN 1 ELSE 0 END) AS agrees FROM m JOIN {values(_AREAS, 'region, st, en')} ON m.ref_pos >= st AND m.ref_pos < en JOIN seed s ON s.rname = m.rname AND s.ref_pos = m.ref_pos GROUP BY ALL),
    per AS (SELECT contig, rname, region, 100 * sum(agrees) / count(*) AS pct_concordance, 100 * count(*) / (en - st) AS pct_covered FROM met GROUP BY contig, rname, region, st, en)
    SELECT c.contig, c.rname, r.region, coalesce(pct_concordance, 0) AS pct_concordance, coalesce(pct_covered, 0) AS pct_covered FROM (SELECT DISTINCT CAST(substr(qname, 2) AS BIGINT) // 65536 AS contig, rname FROM m) c CROSS JOIN (SELECT region FROM {values(_AREAS, 'region, st, en')}) r LEFT JOIN per p ON p.contig = c.contig AND p.rname = c.rname AND p.region = r.region""",
    "sam",
)
def a46(sam: DataFrame) -> DataFrame:
    """Contigs are documents, their reads the aligned segments; the most common base stands for the seed's."""
    matched = cigar.matched_stretches(tokens_of(sam), KEY)
    each = matched.select(F.expr("CAST(substr(qname, 2) AS BIGINT) DIV 65536").alias("contig"), "rname", "start", "letters")
    counted = segments.letter_counts(matched).filter("base <> '-'")
    path = files.scratch(sam.sparkSession)
    counted.groupBy("rname", "ref_pos").agg(F.min(F.struct((-F.col("n")).alias("n"), "base"))["base"].alias("expected")).write.parquet(path)
    seeds = sam.sparkSession.read.parquet(path)  # a row a position of the references
    return segments.seed_concordance(each, seeds, sam.sparkSession.createDataFrame(_AREAS, "region string, start long, end long"))


_HITS = "hits AS (SELECT o_custkey AS contig, concat('ref', o_orderkey % 2) AS ref, CAST(floor(o_totalprice) AS BIGINT) % 40 AS score, o_orderkey * 7919 % 300 AS start, o_orderkey * 7919 % 300 + 15 + o_orderkey % 60 AS \"end\", o_orderkey AS ord FROM orders)"


@query(
    "t14_separate_matches",
    f"""WITH {_HITS}, own AS (SELECT * FROM (SELECT *, first_value(ref) OVER (PARTITION BY contig ORDER BY score DESC, ord) AS best FROM hits) WHERE ref = best),
    lists AS (SELECT contig, list({{'held': range(start, "end"), 'taken': [ord]}} ORDER BY score DESC, ord) AS l FROM own GROUP BY contig),
    folded AS (SELECT contig, list_reduce(l, lambda a, x: CASE WHEN len(list_intersect(a.held, x.held)) < 0.1 * len(x.held) THEN {{'held': list_distinct(list_concat(a.held, x.held)), 'taken': list_concat(a.taken, x.taken)}} ELSE a END).taken AS taken FROM lists)
    SELECT o.contig, ref, score, start, "end", ord FROM own o JOIN folded f ON f.contig = o.contig WHERE list_contains(taken, ord)""",
    "orders",
)
def t14(orders: DataFrame) -> DataFrame:
    hits = orders.select(
        F.col("o_custkey").alias("contig"), F.concat(F.lit("ref"), F.col("o_orderkey") % 2).alias("ref"), (F.floor("o_totalprice").cast("long") % 40).alias("score"),
        (F.col("o_orderkey") * 7919 % 300).cast("long").alias("start"), (F.col("o_orderkey") * 7919 % 300 + 15 + F.col("o_orderkey") % 60).cast("long").alias("end"), F.col("o_orderkey").cast("long").alias("ord"),
    )
    return segments.separate_matches(hits)


_SAMPLES = "contigs AS (SELECT o_custkey AS sample, concat('ref', o_orderkey % 2) AS ref, o_orderkey AS id, o_orderkey * 7919 % 200 AS st, o_orderkey * 7919 % 200 + 10 + o_orderkey % 90 AS ei, CASE WHEN o_orderkey % 11 <> 5 THEN CAST(floor(o_totalprice) AS BIGINT) % 50 END AS reads FROM orders)"
_ORDERED = "list_sort(list_transform(l, lambda x: {'o': CASE WHEN len(list_filter(l, lambda y: y.reads IS NULL)) = 0 THEN x.reads ELSE x.ei - x.st END, 'id': x.id, 'st': x.st, 'ei': x.ei, 'reads': x.reads}))"
_MET = "list_transform({0}, lambda x: {{'x': x, 'others': list_filter(l, lambda y: y.id <> x.id AND y.st <= x.ei AND y.ei >= x.st)}})"
_WHOLE = "len(list_filter(list_concat([e.x.st], list_transform(e.others, lambda y: y.ei + 1)), lambda p: p <= e.x.ei AND len(list_filter(e.others, lambda z: z.st <= p AND p <= z.ei)) = 0)) = 0"
_LARGER = "len(list_filter(e.others, lambda y: y.st < e.x.st OR y.ei > e.x.ei)) > 0"
_MORE = "(len(list_filter(e.others, lambda y: y.reads IS NULL)) = 0 AND coalesce(list_sum(list_transform(e.others, lambda y: y.reads)) > e.x.reads, false))"


@query(
    "i3_cover_removal",
    f"""WITH RECURSIVE {_SAMPLES}, steps AS (SELECT sample, ref, 0 AS step, list({{'id': id, 'st': st, 'ei': ei, 'reads': reads}} ORDER BY id) AS l, true AS going FROM contigs GROUP BY ALL
     UNION ALL SELECT sample, ref, step + 1, list_filter(l, lambda y: y.id IS DISTINCT FROM gone), gone IS NOT NULL FROM
      (SELECT *, list_filter({_MET.format(_ORDERED)}, lambda e: {_WHOLE} AND ({_LARGER} OR {_MORE}))[1].x.id AS gone FROM steps WHERE going) s),
    last_ AS (SELECT sample, ref, unnest(arg_max(l, step)) AS c FROM steps GROUP BY sample, ref)
    SELECT sample, ref, c.id AS id, c.st AS r_st, c.ei AS r_ei, c.reads AS reads FROM last_""",
    "orders",
)
def i3(orders: DataFrame) -> DataFrame:
    """Contigs of customers as samples; of some the reads are unknown."""
    start = F.col("o_orderkey") * 7919 % 200
    reads = F.when(F.col("o_orderkey") % 11 != 5, F.floor("o_totalprice") % 50).cast("long")
    spans = orders.select(F.col("o_custkey").alias("sample"), F.concat(F.lit("ref"), F.col("o_orderkey") % 2).alias("ref"), F.col("o_orderkey").cast("long").alias("id"), start.cast("long").alias("r_st"), (start + 10 + F.col("o_orderkey") % 90).cast("long").alias("r_ei"), reads.alias("reads"))
    return intervals.without_covered(spans, ["sample", "ref"])


@query(
    "a20_match_spectrum",
    """WITH p AS (SELECT item_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM benchmark),
    w AS (SELECT item_id, k, i, substr(seq, CAST(i + 1 AS INT), k) AS kmer FROM (SELECT *, unnest(range(0, length(seq) - k + 1)) AS i FROM p, (VALUES (1), (2), (3), (4)) v(k)) x), own AS (SELECT item_id, k, kmer, max(i) AS i FROM w GROUP BY ALL),
    met AS (SELECT o.k AS size, o.kmer, len(list_filter(range(1, o.k + 1), lambda t: substr(o.kmer, CAST(t AS INT), 1) = substr(w.kmer, CAST(t AS INT), 1))) AS matches FROM own o JOIN w ON w.item_id = o.item_id AND w.k = o.k AND abs(w.i - o.i) >= o.k)
    SELECT size, kmer, CAST(matches AS INT) AS matches, count(*) AS occurrences FROM met WHERE matches > 0 GROUP BY ALL""",
    "benchmark",
)
def a20(benchmark: DataFrame) -> DataFrame:
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return kmers.match_spectrum(benchmark.select(F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC").alias("seq")), "seq", 4)
