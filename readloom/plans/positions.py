"""Queries on intervals and along positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions.tables import values
from readloom.operators import counts, intervals, windows
from readloom.plans.reads import _WIDE
from readloom.plans.registry import query
from readloom.plans.scalars import _TOKENS, KEY, tokens_of

REGIONS = [(f"ref{r}", f"gene{k}", 1 + 4000 * k + 100 * r, 3500 + 4000 * k) for r in range(5) for k in range(10)]


def regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGIONS, "ref string, name string, start long, end long")


@query("j7_region_of_position", f'SELECT id, name FROM spans s JOIN (SELECT * FROM {values(REGIONS, "ref, name, st, en")}) g ON g.ref = s.ref AND r_st BETWEEN st AND en', "spans")
def j7(spans: DataFrame) -> DataFrame:
    return intervals.containing(spans, regions(spans.sparkSession), "ref", "r_st").select("id", "name")


_MARKS = [("c1", f"g{i}", 100 * i + 1, None if i % 2 else 100 * i + 80, "N" if i == 4 else None) for i in range(9)] + [("c2", "x", 5, 50, None)]


@query(
    "j8_gene_bounds",
    f"SELECT s.id, name, en - st + 1 AS size FROM spans s JOIN (SELECT coordinates, name, st, coalesce(en, lead(st) OVER (PARTITION BY coordinates ORDER BY st) - 1) - CASE WHEN coalesce(stop, '') = 'N' THEN 0 ELSE 3 END AS en FROM {values(_MARKS, 'coordinates, name, st, en, stop')}) g ON s.r_st % 1000 BETWEEN st AND en AND coordinates = CASE WHEN s.id % 2 = 0 THEN 'c1' ELSE 'c2' END",
    "spans",
)
def j8(spans: DataFrame) -> DataFrame:
    marks = spans.sparkSession.createDataFrame(_MARKS, "coordinates string, name string, start long, end long, stop string")
    genes = intervals.gene_bounds(marks).filter("end IS NOT NULL").withColumnRenamed("coordinates", "c")
    placed = spans.select("id", (F.col("r_st") % 1000).alias("at"), F.when(F.col("id") % 2 == 0, "c1").otherwise("c2").alias("c"))
    return intervals.containing(placed, genes, "c", "at").select("id", "name", (F.col("end") - F.col("start") + 1).alias("size"))


_PATTERNS = [("HCV-1.*", 1, "H77"), ("HCV-[1-3]a", 2, "JFH"), ("HCV-.*b", 3, "EUB"), (".*", 4, "ANY")]


@query("j9_first_matching_pattern", f"SELECT seed, first(coordinates ORDER BY ord) AS coordinates FROM (SELECT DISTINCT seed FROM aminos) s JOIN (SELECT * FROM {values(_PATTERNS, 'pattern, ord, coordinates')}) p ON regexp_full_match(seed, pattern) GROUP BY seed", "aminos")
def j9(aminos: DataFrame) -> DataFrame:
    return intervals.first_matching(aminos, aminos.sparkSession.createDataFrame(_PATTERNS, "pattern string, ord int, coordinates string"))


_PAIRS = "pairs AS (SELECT a.*, b.id AS other, b.r_st AS o_st, b.r_ei AS o_ei, b.reads AS o_reads FROM spans a JOIN spans b ON a.ref = b.ref AND a.id <> b.id AND a.r_st <= b.r_ei AND b.r_st <= a.r_ei)"


@query("j26_overlapping", f"WITH {_PAIRS} SELECT id, first(other ORDER BY o_ei - o_st DESC, other) AS partner FROM pairs GROUP BY id", "spans")
def j26(spans: DataFrame) -> DataFrame:
    return intervals.best_partner(spans)


@query(
    "j27_gaps_covered",
    "WITH s AS (SELECT *, id % 2 AS strand FROM spans), g AS (SELECT DISTINCT ref, strand, r_ei + 1 AS gap_st, lead(r_st) OVER (PARTITION BY ref, strand ORDER BY r_st, r_ei, id) - 1 AS gap_ei FROM s) SELECT DISTINCT ref, gap_st, gap_ei FROM g WHERE gap_ei - gap_st + 1 > 21 AND EXISTS (SELECT 1 FROM s WHERE s.ref = g.ref AND s.strand <> g.strand AND s.r_st <= gap_ei AND gap_st <= s.r_ei)",
    "spans",
)
def j27(spans: DataFrame) -> DataFrame:
    return intervals.gaps_covered(spans)


_MERGED = "f AS (SELECT *, CASE WHEN r_st <= max(r_ei) OVER (PARTITION BY ref ORDER BY r_st, r_ei ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS new FROM spans), i AS (SELECT *, sum(new) OVER (PARTITION BY ref ORDER BY r_st, r_ei ROWS UNBOUNDED PRECEDING) AS k FROM f)"


@query("w6_merged_intervals", f"WITH {_MERGED} SELECT ref, min(r_st) AS r_st, max(r_ei) AS r_ei FROM i GROUP BY ref, k", "spans")
def w6(spans: DataFrame) -> DataFrame:
    return intervals.merge_intervals(spans)


@query(
    "u6_covered_intervals",
    f"""WITH {_PAIRS}, m AS (SELECT *, CASE WHEN o_st <= max(o_ei) OVER (PARTITION BY id ORDER BY o_st, o_ei, other ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS new FROM pairs),
    k AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY o_st, o_ei, other ROWS UNBOUNDED PRECEDING) AS s, sum(o_reads) OVER (PARTITION BY id) AS all_reads FROM m),
    g AS (SELECT id, ref, r_st, r_ei, reads, all_reads, min(o_st) AS a, max(o_ei) AS b FROM k GROUP BY id, ref, r_st, r_ei, reads, all_reads, s)
    SELECT DISTINCT id, ref FROM g WHERE (a < r_st AND b >= r_ei) OR (a <= r_st AND b > r_ei) OR (a = r_st AND b = r_ei AND all_reads > reads)""",
    "spans",
)
def u6(spans: DataFrame) -> DataFrame:
    return intervals.covered_by_others(spans)


@query("w19_out_of_order", "SELECT ref, id, row_number() OVER (PARTITION BY ref ORDER BY id) <> row_number() OVER (PARTITION BY ref ORDER BY r_st, id) AS moved, lag(r_ei) OVER (PARTITION BY ref ORDER BY id) AS before_end, lead(r_st) OVER (PARTITION BY ref ORDER BY id) AS after_start FROM spans", "spans")
def w19(spans: DataFrame) -> DataFrame:
    return intervals.out_of_order(spans)


@query("w18_step_runs", "SELECT ref, min(p) AS first, max(p) AS last, count(*) AS n FROM (SELECT ref, p, p - 3 * row_number() OVER (PARTITION BY ref ORDER BY p) AS k FROM (SELECT DISTINCT ref, r_st // 50 * 3 AS p FROM spans)) GROUP BY ref, k", "spans")
def w18(spans: DataFrame) -> DataFrame:
    places = spans.select("ref", (F.floor(F.col("r_st") / 50) * 3).alias("p")).distinct()
    return intervals.runs_of_positions(places, ["ref"], "p", 3)


@query("w13_covered_runs", f"WITH {_WIDE} SELECT refname, covered, min(pos) AS first, max(pos) AS last, count(*) AS n FROM (SELECT *, pos - row_number() OVER (PARTITION BY refname, covered ORDER BY pos) AS k FROM (SELECT refname, pos, coverage >= 100 AS covered FROM wide)) GROUP BY refname, covered, k", "aligned")
def w13(aligned: DataFrame) -> DataFrame:
    wide = counts.pileup(counts.position_bases(aligned)).select("refname", "pos", (F.col("coverage") >= 100).alias("covered"))
    return intervals.runs_of_positions(wide, ["refname", "covered"], "pos")


_DELETIONS = "dels AS (SELECT ord, i - 1 AS pos FROM (SELECT ord, seq, unnest(range(1, length(seq) + 1)) AS i FROM aligned) x WHERE substr(seq, CAST(i AS INT), 1) = '-'), d2 AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY ord ORDER BY pos) >= 13 THEN 1 ELSE 0 END AS new FROM dels), d3 AS (SELECT *, sum(new) OVER (PARTITION BY ord ORDER BY pos ROWS UNBOUNDED PRECEDING) AS g FROM d2), groups_ AS (SELECT ord, min(pos) AS first, max(pos) AS last, count(*) AS n, list(pos ORDER BY pos)[count(*) // 2 + 1] AS anchor FROM d3 GROUP BY ord, g HAVING max(pos) - min(pos) < 13 AND count(*) % 3 = 0)"


def deletion_positions(aligned: DataFrame) -> DataFrame:
    return aligned.select("ord", F.posexplode(F.filter(F.split("seq", ""), lambda c: c != "")).alias("pos", "b")).filter("b = '-'").select("ord", F.col("pos").cast("long"))


@query("w15_deletion_groups", f"WITH {_DELETIONS} SELECT * FROM groups_", "aligned")
def w15(aligned: DataFrame) -> DataFrame:
    return intervals.deletion_groups(deletion_positions(aligned), ["ord"])


@query("w16_aligned_deletions", f"WITH {_DELETIONS} SELECT ord, first, n, anchor - n // 2 + CASE (anchor - n // 2 + ord % 3) % 3 WHEN 1 THEN -1 WHEN 2 THEN 1 ELSE 0 END AS new_first FROM groups_", "aligned")
def w16(aligned: DataFrame) -> DataFrame:
    groups = intervals.deletion_groups(deletion_positions(aligned), ["ord"])
    return intervals.shifted_deletions(groups, F.col("ord") % 3).select("ord", "first", "n", "new_first")


@query("j30_lifted_counts", f"WITH {_TOKENS} SELECT rname, op, ref_pos, count(*) AS n, CAST(sum(query_pos) AS BIGINT) AS q FROM (SELECT rname, op, CASE WHEN op <> 'D' THEN q0 + i + 1 END AS query_pos, CASE WHEN op <> 'I' THEN pos + r0 + i END AS ref_pos FROM (SELECT *, unnest(range(0, len)) AS i FROM tokens WHERE op <> 'S') x) GROUP BY ALL", "sam")
def j30(sam: DataFrame) -> DataFrame:
    return intervals.lifted(tokens_of(sam), KEY).groupBy("rname", "op", "ref_pos").agg(F.count(F.lit(1)).alias("n"), F.sum("query_pos").alias("q"))


_BAD = "bad AS (SELECT *, bool_or(errorrate IS NULL OR errorrate >= 7.5) OVER (PARTITION BY tile, cycle < 0 ORDER BY abs(cycle) ROWS UNBOUNDED PRECEDING) AS is_bad FROM quality)"


@query("w1_bad_cycles", f"WITH {_BAD} SELECT tile, cycle, errorrate FROM bad WHERE is_bad", "quality")
def w1(quality: DataFrame) -> DataFrame:
    return windows.bad_cycles(quality)


@query("w1_bad_tiles", f"WITH {_BAD} SELECT tile, count(*) FILTER (WHERE is_bad) AS bad_cycles FROM bad GROUP BY tile", "quality")
def w1_tiles(quality: DataFrame) -> DataFrame:
    return windows.bad_tiles(quality)


_MATCHES = f"{_WIDE}, m AS (SELECT refname, pos, CAST(\"A\" >= \"C\" AS INT) AS match, CAST(coverage >= 100 AS INT) AS covered FROM wide)"


def matches(aligned: DataFrame) -> DataFrame:
    """Positions at which A is at least as frequent as C stand for matches."""
    wide = counts.pileup(counts.position_bases(aligned))
    return wide.select("refname", "pos", (F.col("A") >= F.col("C")).cast("int").alias("match"), (F.col("coverage") >= 100).cast("int").alias("covered"))


@query("w3_trailing_concordance", f"WITH {_MATCHES} SELECT refname, k - 10 AS position, 100 * s / 20 AS pct_concordance, 100 * c / 20 AS pct_covered FROM (SELECT *, row_number() OVER (PARTITION BY refname ORDER BY pos) AS k, sum(match) OVER w AS s, sum(covered) OVER w AS c FROM m WINDOW w AS (PARTITION BY refname ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) WHERE k >= 20", "aligned")
def w3(aligned: DataFrame) -> DataFrame:
    return windows.trailing_concordance(matches(aligned), ["refname"])


@query("w4_centred_concordance", f"WITH {_MATCHES} SELECT refname, pos, round(avg(match) OVER (PARTITION BY refname ORDER BY pos ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING), 9) AS concordance FROM m", "aligned")
def w4(aligned: DataFrame) -> DataFrame:
    return windows.centred_concordance(matches(aligned), ["refname"]).withColumn("concordance", F.round("concordance", 9))


@query("w5_full_windows", f"WITH {_MATCHES} SELECT refname, pos, round(a, 9) AS mean FROM (SELECT refname, pos, count(*) OVER w AS k, avg(match) OVER w AS a FROM m WINDOW w AS (PARTITION BY refname ORDER BY pos RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING)) WHERE k = 31", "aligned")
def w5(aligned: DataFrame) -> DataFrame:
    return windows.full_windows(matches(aligned), ["refname"], "match").withColumn("mean", F.round("mean", 9))


def _runs(flag: str, name: str) -> str:
    return f"""c{name} AS (SELECT refname, pos, {flag} AS f, sum({flag}) OVER (PARTITION BY refname ORDER BY pos) AS cu, sum({flag}) OVER (PARTITION BY refname ORDER BY pos DESC) AS cd FROM m),
    r{name} AS (SELECT refname, pos, cu - max(CASE WHEN f = 0 THEN cu ELSE 0 END) OVER (PARTITION BY refname ORDER BY pos) AS forward, cd - max(CASE WHEN f = 0 THEN cd ELSE 0 END) OVER (PARTITION BY refname ORDER BY pos DESC) AS backward FROM c{name})"""


_SCORES = f"{_MATCHES}, {_runs('match', 'p')}, {_runs('(1 - match)', 'n')}, sc AS (SELECT refname, pos, round(sqrt(p.forward) + sqrt(p.backward) - sqrt(n.forward) - sqrt(n.backward), 9) AS score FROM rp p JOIN rn n USING (refname, pos))"


@query("w7_match_runs", f"WITH {_MATCHES}, {_runs('match', 'p')} SELECT refname, pos, CAST(forward AS BIGINT) AS forward, CAST(backward AS BIGINT) AS backward FROM rp", "aligned")
def w7(aligned: DataFrame) -> DataFrame:
    return windows.true_runs(matches(aligned), ["refname"], "pos", F.col("match") == 1).select("refname", "pos", "forward", "backward")


@query("w8_concordance_scores", f"WITH {_SCORES} SELECT refname, pos, round(score, 6) AS score, round(CASE WHEN hi = lo THEN CAST(score > 0 AS INT) ELSE (score - lo) / (hi - lo) END, 6) AS norm FROM (SELECT *, min(score) OVER (PARTITION BY refname) AS lo, max(score) OVER (PARTITION BY refname) AS hi FROM sc)", "aligned")
def w8(aligned: DataFrame) -> DataFrame:
    scored = windows.concordance_scores(matches(aligned), ["refname"], "pos", F.col("match") == 1)
    return scored.select("refname", "pos", F.round("score", 6).alias("score"), F.round("norm", 6).alias("norm"))


@query("w9_best_cut", f"WITH {_SCORES}, n AS (SELECT *, row_number() OVER (PARTITION BY refname ORDER BY pos) - 1 AS i, count(*) OVER (PARTITION BY refname) AS c FROM sc) SELECT refname, first(pos ORDER BY score DESC, CASE WHEN i < c / 2 THEN i ELSE c - i - 1 END DESC, i) AS cut FROM n GROUP BY refname", "aligned")
def w9(aligned: DataFrame) -> DataFrame:
    return windows.best_cut(windows.concordance_scores(matches(aligned), ["refname"], "pos", F.col("match") == 1), ["refname"], "pos")


@query("w10_direction_changes", "SELECT app, sample, count(*) FILTER (WHERE (x - a) * (a - b) < 0) AS changes FROM (SELECT app, sample, depth AS x, lag(depth) OVER w AS a, lag(depth, 2) OVER w AS b FROM runs WINDOW w AS (PARTITION BY app, sample ORDER BY run_id, line, run_time, depth)) GROUP BY app, sample", "runs")
def w10(runs: DataFrame) -> DataFrame:
    return windows.direction_changes(runs, ["app", "sample"], ["run_id", "line", "run_time", "depth"], "depth")


_LENGTHS = "lengths AS (SELECT length(seq) AS length, count(*) AS n FROM reads GROUP BY 1)"


@query("a21_length_histogram", f"WITH {_LENGTHS} SELECT * FROM lengths", "reads")
def a21(reads: DataFrame) -> DataFrame:
    return reads.groupBy(F.length("seq").cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "w11_length_spikes",
    f"WITH {_LENGTHS}, d AS (SELECT g AS length, coalesce(n, 0) AS n FROM (SELECT unnest(range(-20, (SELECT max(length) FROM lengths) + 21)) AS g) LEFT JOIN lengths ON g = length), w AS (SELECT length, n, list(n) OVER (ORDER BY length ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS l, coalesce(lag(n) OVER (ORDER BY length), 0) AS a, coalesce(lead(n) OVER (ORDER BY length), 0) AS b FROM d) SELECT length, n FROM w WHERE len(l) = 41 AND a <= n AND n > b AND n >= 20 * greatest(list_sort(l)[31], 0.5)",
    "reads",
)
def w11(reads: DataFrame) -> DataFrame:
    return windows.length_spikes(a21(reads))


@query("w12_neighbour_ratios", f"WITH {_LENGTHS}, r AS ({' UNION ALL '.join(f'SELECT length, {b} AS reach, n, (sum(n) OVER (ORDER BY length RANGE BETWEEN {b} PRECEDING AND {b} FOLLOWING) - n) / {2.0 * b} AS o FROM lengths' for b in (3, 4, 5, 6, 7))}) SELECT length, reach, round(n / o, 6) AS ratio FROM r WHERE o > 0", "reads")
def w12(reads: DataFrame) -> DataFrame:
    return windows.neighbour_ratios(a21(reads)).withColumn("ratio", F.round("ratio", 6))


@query(
    "w14_smoothed_coverage",
    f"""WITH {_WIDE}, l AS (SELECT refname, list({{'g': [{{'value': coverage, 'size': CAST(1 AS INT)}}]}} ORDER BY pos) AS own FROM wide GROUP BY refname),
    r AS (SELECT refname, list_reduce(own, lambda a, x: CASE WHEN x.g[1].value BETWEEN a.g[len(a.g)].value * 0.9 AND a.g[len(a.g)].value * 1.1 THEN {{'g': list_concat(a.g[1:len(a.g) - 1], [{{'value': a.g[len(a.g)].value, 'size': CAST(a.g[len(a.g)].size + 1 AS INT)}}])}} ELSE {{'g': list_concat(a.g, x.g)}} END).g AS groups FROM l),
    k AS (SELECT refname, groups, unnest(range(1, len(groups) + 1)) AS i FROM r)
    SELECT refname, CAST(i - 1 AS INT) AS i, groups[i].value AS value, groups[i].size AS size FROM k""",
    "aligned",
)
def w14(aligned: DataFrame) -> DataFrame:
    wide = counts.pileup(counts.position_bases(aligned))
    grouped = windows.smoothed(wide, ["refname"], "coverage").select("refname", F.posexplode("groups").alias("i", "g"))
    return grouped.select("refname", "i", "g.value", "g.size")


@query(
    "w21_dropoff",
    f"WITH {_WIDE}, v AS (SELECT refname, pos, \"A\" AS v, row_number() OVER (PARTITION BY refname ORDER BY pos) AS i FROM wide), f AS (SELECT a.refname, a.pos, a.i, max(b.v * pow(2.0, b.i - a.i)) AS x FROM v a JOIN v b ON a.refname = b.refname AND b.i <= a.i GROUP BY ALL) SELECT a.refname, a.pos, round(max(b.x * pow(2.0, a.i - b.i)), 6) AS smooth FROM f a JOIN f b ON a.refname = b.refname AND b.i >= a.i GROUP BY ALL",
    "aligned",
)
def w21(aligned: DataFrame) -> DataFrame:
    wide = counts.pileup(counts.position_bases(aligned))
    return windows.dropoff(wide, ["refname"], "pos", "A").select("refname", "pos", F.round("smooth", 6).alias("smooth"))


_BLOCKS = [("r1", 1, 1, 400, True), ("r2", 2, 301, 700, True), ("r3", 3, 650, 900, False), ("r4", 4, 880, 1000, True)]


@query(
    "w17_combined_regions",
    f"""WITH b AS (SELECT *, greatest(CAST(trunc((coalesce(lag(en) OVER (ORDER BY ord), 0) - st + 1) / 2) AS INT), 0) AS middle FROM {values([(r, o, s, e, int(a)) for r, o, s, e, a in _BLOCKS], 'region, ord, st, en, amino')}),
    e AS (SELECT *, k + st AS pos FROM (SELECT *, unnest(range(0, en - st + 1)) AS k FROM b) x), f AS (SELECT *, min(ord) OVER (PARTITION BY pos) AS fo FROM e), c AS (SELECT pos, last(region ORDER BY ord) AS region FROM f WHERE ord = fo OR (amino = 1 AND k >= middle) GROUP BY pos)
    SELECT region, count(*) AS spans FROM c JOIN spans ON r_st % 1000 = pos GROUP BY region""",
    "spans",
)
def w17(spans: DataFrame) -> DataFrame:
    blocks = spans.sparkSession.createDataFrame(_BLOCKS, "region string, ord int, start long, end long, is_amino boolean")
    found = windows.combined_regions(blocks)
    return spans.select((F.col("r_st") % 1000).alias("pos")).join(found, "pos").groupBy("region").agg(F.count(F.lit(1)).alias("spans"))

