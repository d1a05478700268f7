"""Queries of resistance calls and of exact k-mers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.functions.tables import values
from readloom.operators import distances, kmers, resist
from readloom.plans.registry import query
from readloom.plans.scalars import _RC

_COV = "cov AS (SELECT seed, pos, CAST(sum(n) AS BIGINT) AS coverage FROM aminos GROUP BY ALL)"
_SEEDS = [f"HCV-{g}{t}" for g, t in ((1, "b"), (2, "a"), (3, "b"), (4, "a"), (5, "b"), (6, "a"))]
_WINDOWS = [(s, 1 + 5 * i, 30 + 5 * i) for i, s in enumerate(_SEEDS)]
#: drug, position, aminos of the rule, score, flag.
RULES = [(f"D{d}", 1 + (7 * d + 11 * k) % 60, "ACDEFGHIKLMNPQRSTVWY"[(3 * d + k) % 15 :][:5], k, "Not indicated" if k == 0 else None) for d in range(6) for k in range(5)]
RANGES = [(-(10**6), 3, 1), (4, 7, 4), (8, 10**6, 5)]
LENGTH = 60


def coverage_of(aminos: DataFrame) -> DataFrame:
    return aminos.groupBy("seed", "pos").agg(F.sum("n").cast("long").alias("coverage"))


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "drug string, pos long, rule string, score int, flag string")


@query(
    "r1_coverage_check",
    f"WITH {_COV}, w AS (SELECT * FROM {values(_WINDOWS, 'seed, st, en')}), p AS (SELECT w.seed, st, coalesce(sum(coverage) FILTER (WHERE pos BETWEEN st AND en), 0) / (en - st + 1) AS m, coalesce(max(coverage) FILTER (WHERE pos = st), 0) AS f, coalesce(max(coverage) FILTER (WHERE pos = en), 0) AS l FROM w LEFT JOIN cov ON cov.seed = w.seed GROUP BY w.seed, st, en) SELECT seed, CASE WHEN m < 100 THEN 'low average coverage' WHEN l < 100 THEN 'not enough high-coverage amino acids' WHEN st = 1 AND f < 100 THEN 'not enough high-coverage amino acids' END AS reason FROM p",
    "aminos",
)
def r1(aminos: DataFrame) -> DataFrame:
    return resist.coverage_check(coverage_of(aminos), aminos.sparkSession.createDataFrame(_WINDOWS, "seed string, start long, end long"))


@query(
    "r2_combined_samples",
    f"WITH {_COV}, j AS (SELECT coalesce(a.seed, b.seed) AS seed, coalesce(a.pos, b.pos) AS pos, a.coverage AS a, b.coverage AS b FROM (SELECT seed, pos, coverage FROM cov WHERE pos % 3 <> 0) a FULL JOIN (SELECT seed, pos, coverage * 2 - pos * 40 AS coverage FROM cov WHERE pos % 4 <> 0 AND pos >= 22) b ON a.seed = b.seed AND a.pos = b.pos) SELECT seed, pos, CASE WHEN pos <= 33 AND (b IS NULL OR a > b) THEN a ELSE b END AS coverage, CASE WHEN pos <= 33 AND (b IS NULL OR a > b) THEN 'main' ELSE 'midi' END AS source FROM j WHERE b IS NOT NULL OR pos <= 33",
    "aminos",
)
def r2(aminos: DataFrame) -> DataFrame:
    cov = coverage_of(aminos)
    second = cov.filter("pos % 4 <> 0").select("seed", "pos", (F.col("coverage") * 2 - F.col("pos") * 40).alias("coverage"))
    return resist.combined_samples(cov.filter("pos % 3 <> 0"), second, start=22, end=33)


_PREV = "prev AS (SELECT seed, pos, amino, n / t AS share FROM (SELECT *, sum(n) OVER (PARTITION BY seed, pos) AS t FROM aminos) WHERE n >= greatest(1.0, t * 0.05) AND amino <> '*' AND t >= 100)"
_POS = f"{_PREV}, sets AS (SELECT seed, pos, string_agg(amino, '' ORDER BY amino) AS aminos FROM (SELECT DISTINCT seed, pos, amino FROM prev) GROUP BY ALL), poss AS (SELECT g.seed, g.pos, coalesce(aminos, '') AS aminos FROM (SELECT seed, unnest(range(1, {LENGTH + 1})) AS pos FROM (SELECT DISTINCT seed FROM prev)) g LEFT JOIN sets s ON s.seed = g.seed AND s.pos = g.pos)"


@query("r3_prevalent_aminos", f"WITH {_PREV} SELECT seed, pos, amino, round(share, 6) AS share FROM prev", "aminos")
def r3(aminos: DataFrame) -> DataFrame:
    return resist.prevalent_aminos(aminos).withColumn("share", F.round("share", 6))


def positions_of(aminos: DataFrame) -> DataFrame:
    return resist.padded_positions(resist.prevalent_aminos(aminos), LENGTH)


@query("r3_padded_positions", f"WITH {_POS} SELECT * FROM poss", "aminos")
def r3_padded(aminos: DataFrame) -> DataFrame:
    return positions_of(aminos).select("seed", "pos", F.array_join("aminos", "").alias("aminos"))


_KEYS = [3, 17, 28, 41, 56]


@query("r4_complete_reports", f"WITH {_POS} SELECT seed, bool_and(aminos <> '') AS complete FROM poss WHERE pos IN ({', '.join(map(str, _KEYS))}) GROUP BY seed", "aminos")
def r4(aminos: DataFrame) -> DataFrame:
    return resist.needed_reports(positions_of(aminos), aminos.sparkSession.createDataFrame([(k,) for k in _KEYS], "pos int"))


_RULES = f"rules AS (SELECT * FROM {values(RULES, 'drug, pos, rule, score, flag')}), hits AS (SELECT seed, drug, aminos, score, flag, regexp_matches(aminos, concat('[', rule, ']')) AS meets FROM poss JOIN rules ON rules.pos = poss.pos), scored AS (SELECT seed, drug, CAST(coalesce(sum(score) FILTER (WHERE meets), 0) AS BIGINT) AS score, coalesce(bool_or(flag IS NOT NULL AND meets), false) AS flagged, bool_or(aminos = '') AS missing FROM hits GROUP BY ALL)"
_LEVEL = "CASE WHEN missing THEN 0 WHEN score = 0 AND flagged THEN 2 WHEN score <= 3 THEN 1 WHEN score <= 7 THEN 4 ELSE 5 END"


@query("r6_rule_scores", f"WITH {_POS}, {_RULES} SELECT seed, drug, score, flagged, missing FROM scored", "aminos")
def r6(aminos: DataFrame) -> DataFrame:
    scored = resist.rule_scores(positions_of(aminos), rules(aminos.sparkSession))
    return scored.select("seed", "drug", "score", (F.size("flags") > 0).alias("flagged"), "missing")


@query("r7_levels", f"WITH {_POS}, {_RULES} SELECT seed, drug, {_LEVEL} AS level FROM scored", "aminos")
def r7(aminos: DataFrame) -> DataFrame:
    return resist.levels(resist.rule_scores(positions_of(aminos), rules(aminos.sparkSession)), RANGES).select("seed", "drug", "level")


_WILD = [(p, "ACDEFGHIKLMNPQRSTVWY"[p % 20]) for p in range(1, LENGTH + 1)]


@query(
    "r8_wild_type_pass",
    f"""WITH {_POS}, {_RULES}, one AS (SELECT seed, drug, {_LEVEL} AS one FROM scored), w AS (SELECT * FROM {values(_WILD, 'pos, wild')}),
    h2 AS (SELECT seed, drug, score, flag, regexp_matches(CASE WHEN aminos = '' THEN wild ELSE aminos END, concat('[', rule, ']')) AS meets FROM poss JOIN rules ON rules.pos = poss.pos JOIN w ON w.pos = poss.pos),
    s2 AS (SELECT seed, drug, coalesce(sum(score) FILTER (WHERE meets), 0) AS score, coalesce(bool_or(flag IS NOT NULL AND meets), false) AS flagged, false AS missing FROM h2 GROUP BY ALL), two AS (SELECT seed, drug, {_LEVEL} AS two FROM s2)
    SELECT seed, drug, CASE WHEN one = 0 AND two > 1 THEN two ELSE one END AS level FROM one JOIN two USING (seed, drug)""",
    "aminos",
)
def r8(aminos: DataFrame) -> DataFrame:
    spark = aminos.sparkSession
    return resist.wild_type_pass(positions_of(aminos), spark.createDataFrame(_WILD, "pos long, wild string"), rules(spark), RANGES)


@query("r9_reported_mutations", f"WITH {_PREV}, {_POS[len(_PREV) + 2:]}, {_RULES} SELECT p.seed, pos, amino, round(share, 6) AS share FROM prev p WHERE p.seed NOT IN (SELECT seed FROM scored GROUP BY seed HAVING bool_and(missing))", "aminos")
def r9(aminos: DataFrame) -> DataFrame:
    failed = resist.rule_scores(positions_of(aminos), rules(aminos.sparkSession)).groupBy("seed").agg(F.bool_and("missing").alias("all")).filter("all")
    return resist.prevalent_aminos(aminos).join(failed, "seed", "left_anti").withColumn("share", F.round("share", 6))


@query("r11_region_consensus", f"WITH {_POS}, t AS (SELECT seed, string_agg(CASE length(aminos) WHEN 0 THEN '-' WHEN 1 THEN aminos ELSE concat('[', aminos, ']') END, '' ORDER BY pos) AS a FROM poss GROUP BY seed) SELECT seed, length(a) - length(ltrim(a, '-')) AS \"offset\", trim(a, '-') AS consensus FROM t", "aminos")
def r11(aminos: DataFrame) -> DataFrame:
    return resist.region_consensus(positions_of(aminos))


@query("r12_failures", f"WITH {_COV} SELECT seed, CASE WHEN max(coverage) < 3500 THEN 'MIDI: low coverage' ELSE 'low coverage' END AS reason FROM cov WHERE coverage < 4000 GROUP BY seed", "aminos")
def r12(aminos: DataFrame) -> DataFrame:
    low = coverage_of(aminos).filter("coverage < 4000").groupBy("seed").agg(F.max("coverage").alias("m"))
    return low.select("seed", F.when(F.col("m") < 3500, "MIDI: low coverage").otherwise("low coverage").alias("reason"))


@query("r13_rule_sets", "SELECT seed AS genotype, CASE WHEN seed IN ('HCV-1b', 'HCV-2a') THEN concat('rules of ', seed) WHEN seed = 'HCV-3b' THEN 'rules of HCV-1b' ELSE 'Not available' END AS rules FROM (SELECT DISTINCT seed FROM aminos)", "aminos")
def r13(aminos: DataFrame) -> DataFrame:
    own = [(s, f"rules of {s}") for s in ("HCV-1b", "HCV-2a")]
    available = aminos.sparkSession.createDataFrame(own, "genotype string, rules string")
    return resist.rule_sets(aminos.select(F.col("seed").alias("genotype")).distinct(), available, {"HCV-3b": "HCV-1b", "HCV-4a": "HCV-9"})


@query("r14_drug_order", f"WITH {_POS}, {_RULES} SELECT seed, drug, row_number() OVER (PARTITION BY seed ORDER BY right(drug, 1)::INT % 2 DESC, drug) AS place FROM scored", "aminos")
def r14(aminos: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    scored = resist.rule_scores(positions_of(aminos), rules(aminos.sparkSession))
    group = F.substring("drug", -1, 1).cast("int") % 2
    return scored.select("seed", "drug", F.row_number().over(Window.partitionBy("seed").orderBy(F.desc(group), "drug")).alias("place"))


@query("r15_complete_drug_lists", f"WITH {_POS}, {_RULES} SELECT g.seed, g.drug, CASE WHEN s.drug IS NULL THEN 0 ELSE {_LEVEL} END AS level FROM (SELECT seed, unnest(['D0', 'D1', 'D2', 'D3', 'D4', 'D5', 'D6', 'D7']) AS drug FROM (SELECT DISTINCT seed FROM aminos)) g LEFT JOIN (SELECT * FROM scored) s ON s.seed = g.seed AND s.drug = g.drug WHERE s.drug IS NOT NULL OR g.drug >= 'D6'", "aminos")
def r15(aminos: DataFrame) -> DataFrame:
    calls = resist.levels(resist.rule_scores(positions_of(aminos), rules(aminos.sparkSession)), RANGES)
    known = F.explode(F.array(*(F.lit(f"D{i}") for i in range(8)))).alias("drug")
    wanted = aminos.select("seed").distinct().select("seed", known)
    joined = wanted.join(calls.select("seed", "drug", "level"), ["seed", "drug"], "left")
    return joined.withColumn("level", F.coalesce("level", F.lit(0)))


_PLACED = f"both_ AS (SELECT seq AS s FROM pieces60 WHERE length(seq) = 60 UNION ALL SELECT {_RC.format('seq')} FROM pieces60 WHERE length(seq) = 60), cnt AS (SELECT s AS kmer, count(*) AS n FROM both_ GROUP BY s), km AS (SELECT doc_id AS contig, start, substr(seq, CAST(start + 1 AS INT), 60) AS kmer FROM (SELECT doc_id, seq, unnest(range(0, length(seq) - 59)) AS start FROM seqs) x), placed AS (SELECT contig, start, CAST(sum(n) AS BIGINT) AS n FROM km JOIN cnt ON cnt.kmer = km.kmer GROUP BY ALL)"


def placed_of(seqs: DataFrame, pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    contigs = seqs.select(F.col("doc_id").alias("contig"), "seq")
    return kmers.placements(pieces, contigs, 60), contigs


@query("j6_exact_placements", f"WITH {_PLACED} SELECT contig, start, n FROM placed", "seqs", "pieces60")
def j6(seqs: DataFrame, pieces: DataFrame) -> DataFrame:
    return placed_of(seqs, pieces)[0]


@query("a16_exact_coverage", f"WITH {_PLACED}, b AS (SELECT contig, start + i AS pos, sum(n) AS c FROM (SELECT *, unnest(range(10, 50)) AS i FROM placed) x GROUP BY ALL) SELECT contig, count(*) AS covered, CAST(sum(c) AS BIGINT) AS total FROM b GROUP BY contig", "seqs", "pieces60")
def a16(seqs: DataFrame, pieces: DataFrame) -> DataFrame:
    """Without the ten bases at each end of a read."""
    placed, contigs = placed_of(seqs, pieces)
    return kmers.covered_bases(kmers.coverage(placed, contigs, 60, inner=10))


@query("a17_longest_contig_coverage", f"WITH {_PLACED}, b AS (SELECT contig, start + i AS pos, sum(n) AS c FROM (SELECT *, unnest(range(0, 60)) AS i FROM placed) x GROUP BY ALL), l AS (SELECT source, first(doc_id ORDER BY length(seq) DESC, doc_id) AS contig FROM seqs GROUP BY source) SELECT contig, count(*) AS covered, CAST(sum(c) AS BIGINT) AS total FROM b WHERE contig IN (SELECT contig FROM l) GROUP BY contig", "seqs", "pieces60")
def a17(seqs: DataFrame, pieces: DataFrame) -> DataFrame:
    """Of the longest contig of each source."""
    longest = seqs.groupBy("source").agg(F.min(F.struct((-F.length("seq")).alias("n"), "doc_id"))["doc_id"].alias("doc_id"))
    placed, contigs = placed_of(seqs.join(longest.select("doc_id"), "doc_id", "left_semi"), pieces)
    return kmers.covered_bases(kmers.coverage(placed, contigs, 60))


@query(
    "j20_shared_kmers",
    """WITH km AS (SELECT DISTINCT doc_id, substr(seq, CAST(i + 1 AS INT), 30) AS kmer FROM (SELECT doc_id, seq, unnest(range(0, length(seq) - 29)) AS i FROM seqs) x),
    owned AS (SELECT kmer, list(doc_id ORDER BY doc_id) AS owners FROM km GROUP BY kmer HAVING count(*) > 1), classes AS (SELECT owners, count(*) AS kmers FROM owned GROUP BY owners)
    SELECT unnest(owners) AS doc_id, owners[1] AS first, len(owners) AS members, kmers, false AS always FROM classes
    UNION ALL SELECT doc_id, NULL, NULL, NULL, true FROM seqs WHERE length(seq) < 30""",
    "seqs",
)
def j20(seqs: DataFrame) -> DataFrame:
    return kmers.sharing(seqs, "doc_id", 30)


_GRAMS = "list_sum(list_transform(range(1, 257), lambda i: abs(a.v[i] - b.v[i])))"


@query(
    "j21_nearest_reference",
    f"""WITH four AS (SELECT concat(a, b, c, d) AS gram FROM (VALUES ('A'), ('C'), ('G'), ('T')) w(a), (VALUES ('A'), ('C'), ('G'), ('T')) x(b), (VALUES ('A'), ('C'), ('G'), ('T')) y(c), (VALUES ('A'), ('C'), ('G'), ('T')) z(d)),
    grams AS (SELECT doc_id, substr(seq, CAST(i AS INT), 4) AS gram, count(*) AS n FROM (SELECT doc_id, seq, unnest(range(1, length(seq) - 2)) AS i FROM seqs) GROUP BY ALL),
    s AS MATERIALIZED (SELECT doc_id, any_value(source) AS source, any_value(seq) AS seq, any_value(length(seq)) AS size, list(coalesce(n, 0) ORDER BY f.gram) AS v FROM seqs CROSS JOIN four f LEFT JOIN grams g USING (doc_id, gram) GROUP BY doc_id),
    sized AS MATERIALIZED (SELECT a.doc_id AS id, b.doc_id AS reference FROM s a JOIN s b ON a.doc_id < b.doc_id AND b.size >= a.size - 32 AND b.size <= a.size + 32),
    p AS MATERIALIZED (SELECT id, a.source AS kind, reference, b.source AS other, a.seq AS one, b.seq AS two FROM sized JOIN s a ON a.doc_id = id JOIN s b ON b.doc_id = reference WHERE {_GRAMS} <= 2 * 4 * 32),
    d AS MATERIALIZED (SELECT * FROM (SELECT id, kind, reference, other, levenshtein(one, two) AS distance FROM p) WHERE distance <= 32), n AS (SELECT * FROM d UNION ALL SELECT reference, other, id, kind, distance FROM d),
    any_ AS (SELECT id, first(reference ORDER BY distance, reference) AS nearest, min(distance) AS distance FROM n GROUP BY id), own AS (SELECT id, first(reference ORDER BY distance, reference) AS own_nearest, min(distance) AS own_distance FROM n WHERE kind IS NOT DISTINCT FROM other GROUP BY id)
    SELECT s.doc_id AS id, nearest, CAST(distance AS INT) AS distance, own_nearest, CAST(own_distance AS INT) AS own_distance, distance IS NOT NULL AND own_distance IS DISTINCT FROM distance AS reported FROM s LEFT JOIN any_ a ON a.id = s.doc_id LEFT JOIN own o ON o.id = s.doc_id""",
    "seqs",
)
def j21(seqs: DataFrame) -> DataFrame:
    """Each sequence among all others, their sources for genotypes: reported where another source's is nearer than its own's."""
    found = distances.nearest(seqs.select(F.col("doc_id").alias("id"), F.col("source").alias("kind"), "seq"), None, most=32)
    return found.withColumn("reported", F.col("distance").isNotNull() & ~F.col("own_distance").eqNullSafe(F.col("distance")))


_TURNS = "turns AS (SELECT conv_id AS sample, turn AS name, CAST(length(text) % 7 AS BIGINT) AS reads, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS letters, translate(regexp_replace(lower(text), '[^a-df-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS part FROM conversations)"


@query(
    "i1_drifted_references",
    f"""WITH RECURSIVE {_TURNS}, refs AS MATERIALIZED (SELECT sample, name, reads, CASE WHEN reads = 5 THEN '' ELSE letters END AS seq, CASE WHEN name % 2 = 0 THEN coalesce(lead(letters) OVER w, part) ELSE part END AS seed FROM turns WINDOW w AS (PARTITION BY sample ORDER BY name)),
    d AS MATERIALIZED (SELECT a.sample, a.name, b.name AS other, levenshtein(a.seq, b.seed) AS distance FROM refs a JOIN refs b ON a.sample = b.sample WHERE a.name = b.name OR a.seq <> ''),
    own AS (SELECT sample, name, distance AS seed_dist FROM d WHERE name = other), nearer AS MATERIALIZED (SELECT d.sample, d.name, d.other, distance FROM d JOIN own o ON o.sample = d.sample AND o.name = d.name WHERE d.other <> d.name AND distance < seed_dist),
    lists AS MATERIALIZED (SELECT r.sample, r.name, any_value(r.reads) AS reads, any_value(r.seq) = '' AS empty, coalesce(list(n.other) FILTER (WHERE n.other IS NOT NULL), []) AS near FROM refs r LEFT JOIN nearer n ON n.sample = r.sample AND n.name = r.name GROUP BY r.sample, r.name),
    steps AS (SELECT sample, 0 AS step, list({{'reads': reads, 'name': name, 'empty': empty, 'near': near}}) AS l, count(*) > 1 AS going FROM lists GROUP BY sample
     UNION ALL SELECT sample, step + 1, list_filter(l, lambda x: len(gone) = 0 OR x.name <> gone[1].name), len(gone) > 1 AND len(l) > 2 FROM (SELECT *, list_sort(list_filter(l, lambda x: x.empty OR len(list_filter(x.near, lambda o: len(list_filter(l, lambda y: y.name = o)) > 0)) > 0)) AS gone FROM steps WHERE going) s),
    left_ AS (SELECT sample, unnest(list_transform(arg_max(l, step), lambda x: x.name)) AS name FROM steps GROUP BY sample),
    best AS (SELECT sample, name, min(distance) AS other_dist, first(other ORDER BY distance, other) AS other_seed FROM nearer GROUP BY sample, name)
    SELECT o.sample, o.name, CAST(seed_dist AS INT) AS seed_dist, CAST(other_dist AS INT) AS other_dist, other_seed, f.name IS NOT NULL AS kept FROM own o LEFT JOIN best b ON b.sample = o.sample AND b.name = o.name LEFT JOIN left_ f ON f.sample = o.sample AND f.name = o.name""",
    "conversations",
)
def i1(conversations: DataFrame) -> DataFrame:
    """Turns as a conversation's references: their letters for the consensus, without e, or of the next turn, for the seed; some are empty. All are asked, however long."""
    letters = lambda kept: F.translate(F.regexp_replace(F.lower("text"), f"[^{kept}]", ""), "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")
    turns = conversations.select(F.col("conv_id").alias("sample"), F.col("turn").alias("name"), (F.length("text") % 7).cast("long").alias("reads"), letters("a-z").alias("letters"), letters("a-df-z").alias("part"))
    following = F.coalesce(F.lead("letters").over(Window.partitionBy("sample").orderBy("name")), "part")
    seeds = turns.select("sample", "name", F.when(F.col("name") % 2 == 0, following).otherwise(F.col("part")).alias("seq"))
    consensus = turns.select("sample", "name", "reads", F.when(F.col("reads") == 5, "").otherwise(F.col("letters")).alias("seq"))
    return distances.drop_drifted(consensus, seeds, longest=None)


@query("a19_kmer_entropy", "WITH km AS (SELECT lang, substr(seq, CAST(i + 1 AS INT), 12) AS kmer, count(*) AS n FROM (SELECT lang, seq, unnest(range(0, length(seq) - 11)) AS i FROM seqs) x GROUP BY ALL) SELECT lang, round(-sum(n / t * log2(n / t)), 6) AS entropy FROM (SELECT *, sum(n) OVER (PARTITION BY lang) AS t FROM km) GROUP BY lang", "seqs")
def a19(seqs: DataFrame) -> DataFrame:
    return kmers.entropy(seqs, "lang").withColumn("entropy", F.round("entropy", 6))
