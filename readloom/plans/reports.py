"""Queries of run, app and release level reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators import counts, runs
from readloom.plans.reads import _CONS
from readloom.plans.registry import query


@query("a31_run_statistics", "SELECT run_id, round(avg(concordance), 6) AS concordance, round(avg(depth), 6) AS depth, count(sample) AS matches, count(DISTINCT sample) AS unique_matches, count(sample) - count(DISTINCT sample) AS duplicate_matches FROM runs GROUP BY run_id", "runs")
def a31(rows: DataFrame) -> DataFrame:
    out = runs.run_statistics(rows, ["run_id"], ["concordance", "depth"], "sample")
    return out.withColumns({c: F.round(c, 6) for c in ("concordance", "depth")})


@query("a32_soft_clip_total", "SELECT app, CAST(sum(v) AS BIGINT) AS clips FROM (SELECT app, sample, line, max(depth) AS v FROM runs GROUP BY ALL) GROUP BY app", "runs")
def a32(rows: DataFrame) -> DataFrame:
    return runs.soft_clip_total(rows, ["app"], ["sample", "line"], "depth").withColumn("clips", F.col("clips").cast("long"))


@query("a33_zero_positions", "SELECT app, count(*) FILTER (WHERE concordance = 0) AS uncovered FROM runs GROUP BY app", "runs")
def a33(rows: DataFrame) -> DataFrame:
    return rows.groupBy("app").agg(F.count_if(F.col("concordance") == 0).alias("uncovered"))


@query("a34_consensus_fingerprint", "SELECT source, md5(seq) AS fingerprint FROM (SELECT source, seq, row_number() OVER (PARTITION BY source ORDER BY length(seq) DESC, doc_id) AS k FROM seqs) WHERE k = 1", "seqs")
def a34(seqs: DataFrame) -> DataFrame:
    best = seqs.groupBy("source").agg(F.min(F.struct((-F.length("seq")).alias("n"), "doc_id", F.md5("seq").alias("h")))["h"].alias("fingerprint"))
    return best


@query("a35_app_means", "SELECT app, round(avg(concordance), 6) AS concordance, round(avg(depth), 6) AS depth, round(avg(run_time), 4) AS run_time, count(*) AS n FROM runs GROUP BY app", "runs")
def a35(rows: DataFrame) -> DataFrame:
    out = runs.app_means(rows, ["concordance", "depth", "run_time"])
    return out.withColumns({"concordance": F.round("concordance", 6), "depth": F.round("depth", 6), "run_time": F.round("run_time", 4)})


@query("a36_overlap_means", "SELECT app, round(avg(line), 6) AS line, count(*) AS n FROM runs GROUP BY app", "runs")
def a36(rows: DataFrame) -> DataFrame:
    return runs.app_means(rows, ["line"]).withColumn("line", F.round("line", 6))


@query("a37_concordance_statistics", "SELECT app, sample, round(avg(concordance), 6) AS mean, round(stddev_pop(concordance), 6) AS deviation, round(avg(depth * concordance / 100), 6) AS product, count(*) AS n FROM runs WHERE depth > 0 GROUP BY app, sample HAVING count(*) >= 10", "runs")
def a37(rows: DataFrame) -> DataFrame:
    return runs.concordance_statistics(rows, ["app", "sample"]).withColumns({c: F.round(c, 6) for c in ("mean", "deviation", "product")})


@query(
    "a38_quartiles",
    f"WITH k AS (SELECT app, depth, row_number() OVER (PARTITION BY app ORDER BY depth) - 1 AS i, count(*) OVER (PARTITION BY app) AS n FROM runs), q AS (SELECT app, avg(depth) AS mean, {', '.join(f'(max(depth) FILTER (WHERE i = floor((n - 1) * {s})) + max(depth) FILTER (WHERE i = ceil((n - 1) * {s}))) / 2 AS {c}' for s, c in ((0.25, 'q1'), (0.5, 'median'), (0.75, 'q3')))} FROM k GROUP BY app) SELECT app, round(mean, 6) AS mean, q1, median, q3, q3 - q1 AS iqr FROM q",
    "runs",
)
def a38(rows: DataFrame) -> DataFrame:
    return runs.midpoint_quartiles(rows, ["app"], "depth").withColumn("mean", F.round("mean", 6))


@query("a39_median_coverage", "SELECT s.sample, coalesce(median, 0) AS median, coalesce(n, 0) AS n FROM (SELECT DISTINCT sample FROM runs) s LEFT JOIN (SELECT sample, median(depth) AS median, count(*) AS n FROM runs WHERE depth > 0 AND concordance > 0.09 GROUP BY sample) m ON m.sample = s.sample", "runs")
def a39(rows: DataFrame) -> DataFrame:
    covered = rows.filter("concordance > 0.09").select("sample", F.col("depth").cast("double").alias("coverage"))
    return runs.median_coverage(covered, rows.select("sample").distinct())


@query("a40_project_combinations", "SELECT projects, count(*) AS samples, max(run) AS latest FROM (SELECT sample, string_agg(DISTINCT project, '+' ORDER BY project) AS projects, max(ord) AS run FROM scores GROUP BY sample) GROUP BY projects", "scores")
def a40(rows: DataFrame) -> DataFrame:
    return runs.project_combinations(rows.withColumnRenamed("ord", "run"))


@query("a47_mutation_lists", "SELECT seed, string_agg(concat(amino, pos, '(', CAST(floor(100 * n / t) AS BIGINT), '%)'), ', ' ORDER BY pos, amino) AS mutations FROM (SELECT *, sum(n) OVER (PARTITION BY seed, pos) AS t FROM aminos) GROUP BY seed", "aminos")
def a47(aminos: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    total = F.sum("n").over(Window.partitionBy("seed", "pos"))
    text = F.concat("amino", F.col("pos").cast("string"), F.lit("("), F.floor(100 * F.col("n") / total).cast("string"), F.lit("%)"))
    named = aminos.select("seed", "pos", "amino", text.alias("t"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "amino", "t"))), lambda x: x["t"])
    return named.groupBy("seed").agg(F.array_join(ordered, ", ").alias("mutations"))


@query("a48_duplicates", "SELECT seq, count(*) AS n FROM seqs GROUP BY seq HAVING count(*) > 1", "seqs")
def a48(seqs: DataFrame) -> DataFrame:
    return runs.duplicates(seqs, ["seq"])


@query("a49_most_variants", "SELECT region, max(on_score) AS variants FROM scores GROUP BY region", "scores")
def a49(rows: DataFrame) -> DataFrame:
    return rows.groupBy("region").agg(F.max("on_score").alias("variants"))


@query("a52_name_check", "SELECT project, count(*) FILTER (WHERE sample IN (SELECT DISTINCT c_custkey FROM customer WHERE c_nationkey < 13)) AS known, count(*) FILTER (WHERE sample NOT IN (SELECT DISTINCT c_custkey FROM customer WHERE c_nationkey < 13)) AS unknown FROM scores GROUP BY project", "scores", "customer")
def a52(rows: DataFrame, customer: DataFrame) -> DataFrame:
    known = customer.filter("c_nationkey < 13").select(F.col("c_custkey").alias("sample"), F.lit(True).alias("k")).distinct()
    return rows.join(known, "sample", "left").groupBy("project").agg(F.count("k").alias("known"), (F.count(F.lit(1)) - F.count("k")).alias("unknown"))


@query(
    "a42_technology_comparison",
    "SELECT sample, count(*) FILTER (WHERE app = 'AF') AS old_n, count(*) FILTER (WHERE app = 'NO') AS new_n, CAST(sum(depth) FILTER (WHERE app = 'AF') AS BIGINT) AS old_reads, CAST(sum(depth) FILTER (WHERE app = 'NO') AS BIGINT) AS new_reads FROM runs GROUP BY sample",
    "runs",
)
def a42(rows: DataFrame) -> DataFrame:
    per = [(F.when(F.col("app") == app, F.col("depth")), name) for app, name in (("AF", "old"), ("NO", "new"))]
    return rows.groupBy("sample").agg(*(F.count(c).alias(f"{n}_n") for c, n in per), *(F.sum(c).cast("long").alias(f"{n}_reads") for c, n in per))


@query("a22_coverage_scores", "SELECT project, region, seed, min(on_score) AS min_coverage, first(ord ORDER BY on_score, ord) AS which_key_pos, CASE WHEN min(on_score) <= 1 THEN 1 WHEN min(on_score) <= 2 THEN 2 WHEN min(on_score) <= 3 THEN 3 ELSE 4 END AS on_level FROM scores GROUP BY ALL", "scores")
def a22(rows: DataFrame) -> DataFrame:
    from readloom.functions.scores import on_score

    least = F.min(F.struct("on_score", "ord"))
    per = rows.groupBy("project", "region", "seed").agg(least.alias("m"))
    return per.select("project", "region", "seed", F.col("m.on_score").alias("min_coverage"), F.col("m.ord").alias("which_key_pos"), on_score(F.col("m.on_score"), (1, 2, 3)).alias("on_level"))


@query("a23_best_region", "SELECT sample, region, round(m, 6) AS coverage FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY m DESC, o) AS k FROM (SELECT sample, region, avg(on_score) AS m, min(ord) AS o FROM scores GROUP BY ALL)) WHERE k = 1", "scores")
def a23(rows: DataFrame) -> DataFrame:
    per = rows.groupBy("sample", "region").agg(F.avg("on_score").alias("m"), F.min("ord").alias("o"))
    return counts.ranked(per, ["sample"], [F.desc("m"), "o"]).filter("rank = 0").select("sample", "region", F.round("m", 6).alias("coverage"))


@query("a24_rows_with_counts", "SELECT app, run_id, line, sample FROM runs WHERE greatest(concordance, depth - 40) > 0", "runs")
def a24(rows: DataFrame) -> DataFrame:
    return rows.filter(F.greatest(F.col("concordance").cast("double"), F.col("depth").cast("double") - 40) > 0).select("app", "run_id", "line", "sample")


@query("a25_cascade", "SELECT app, CAST(sum(CAST(depth AS BIGINT) // 2) FILTER (WHERE line = 1) AS BIGINT) AS demultiplexed, CAST(sum(CAST(depth AS BIGINT) // 2) FILTER (WHERE line IN (2, 3)) AS BIGINT) AS prelim, CAST(sum(CAST(depth AS BIGINT)) FILTER (WHERE line > 3) AS BIGINT) AS aligned FROM runs GROUP BY app", "runs")
def a25(rows: DataFrame) -> DataFrame:
    n, line = F.col("depth").cast("long"), F.col("line")
    half = F.floor(n / 2)
    return rows.groupBy("app").agg(F.sum(F.when(line == 1, half)).alias("demultiplexed"), F.sum(F.when(line.isin(2, 3), half)).alias("prelim"), F.sum(F.when(line > 3, n)).alias("aligned"))


@query("a27_good_quality_share", "SELECT cycle < 0 AS reverse, round(sum(CASE WHEN errorrate < 5 THEN 1 ELSE 0 END) / count(*), 6) AS share FROM quality GROUP BY 1", "quality")
def a27(quality: DataFrame) -> DataFrame:
    return quality.groupBy((F.col("cycle") < 0).alias("reverse")).agg(F.round(F.count_if(F.col("errorrate") < 5) / F.count(F.lit(1)), 6).alias("share"))


@query("a28_tile_metrics", "SELECT round(avg(errorrate) FILTER (WHERE abs(cycle) = 1), 6) AS density, round(sum(errorrate) FILTER (WHERE abs(cycle) = 2) / sum(errorrate) FILTER (WHERE abs(cycle) = 3), 6) AS pass_rate FROM quality", "quality")
def a28(quality: DataFrame) -> DataFrame:
    of = lambda c: F.when(F.abs("cycle") == c, F.col("errorrate"))
    return quality.agg(F.round(F.avg(of(1)), 6).alias("density"), F.round(F.sum(of(2)) / F.sum(of(3)), 6).alias("pass_rate"))


@query("a29_weighted_means", "SELECT app, round(sum(concordance * depth) / nullif(sum(depth), 0), 6) AS quality FROM runs GROUP BY app", "runs")
def a29(rows: DataFrame) -> DataFrame:
    weight = F.sum("depth")
    return rows.groupBy("app").agg(F.round((F.sum(F.col("concordance") * F.col("depth")) / F.when(weight != 0, weight)).cast("double"), 6).alias("quality"))


@query("a54_raw_pairs", "SELECT count(DISTINCT pair_id) AS pairs, count(*) AS records FROM reads", "reads")
def a54(reads: DataFrame) -> DataFrame:
    return reads.agg(F.count_distinct("pair_id").alias("pairs"), F.count(F.lit(1)).alias("records"))


@query("j14_joined_tables", "SELECT coalesce(a.sample, b.sample) AS sample, coalesce(CAST(n_af AS VARCHAR), '') AS n_af, coalesce(CAST(n_no AS VARCHAR), '') AS n_no FROM (SELECT concat(sample, line) AS sample, count(*) AS n_af FROM runs WHERE app = 'AF' AND depth > 25 GROUP BY 1) a FULL JOIN (SELECT concat(sample, line + 1) AS sample, count(*) AS n_no FROM runs WHERE app = 'NO' AND depth < 25 GROUP BY 1) b ON a.sample = b.sample", "runs")
def j14(rows: DataFrame) -> DataFrame:
    a = rows.filter("app = 'AF' AND depth > 25").groupBy(F.concat("sample", "line").alias("sample")).agg(F.count(F.lit(1)).alias("n_af"))
    b = rows.filter("app = 'NO' AND depth < 25").groupBy(F.concat("sample", F.col("line") + 1).alias("sample")).agg(F.count(F.lit(1)).alias("n_no"))
    return runs.joined_tables([a, b], "sample")


@query("j15_app_differences", "WITH p AS (SELECT app, sample, avg(depth) AS depth, min(concat('t', line)) AS line FROM runs GROUP BY ALL) SELECT a.sample, round(b.depth - a.depth, 6) AS depth, round(a.depth, 6) AS depth_base, CASE WHEN a.line = b.line THEN a.line ELSE concat(a.line, '/', b.line) END AS line FROM p a JOIN p b ON a.sample = b.sample AND a.app = 'AF' AND b.app = 'NO'", "runs")
def j15(rows: DataFrame) -> DataFrame:
    out = runs.app_differences(rows.withColumn("line", F.concat(F.lit("t"), "line")), "AF", "NO", ["depth"], ["line"])
    return out.withColumns({c: F.round(c, 6) for c in ("depth", "depth_base")})


@query("j15_same_app", "SELECT sample, round(avg(d), 6) AS depth FROM (SELECT sample, abs(depth - lag(depth) OVER (PARTITION BY sample ORDER BY run_id, line, run_time, depth)) AS d FROM runs WHERE app = 'AF') GROUP BY sample", "runs")
def j15_same(rows: DataFrame) -> DataFrame:
    return runs.consecutive_differences(rows.filter("app = 'AF'"), ["run_id", "line", "run_time", "depth"], "depth").withColumn("depth", F.round("depth", 6))


_NAMES = "names AS (SELECT DISTINCT concat('s', sample // 2, CASE sample % 4 WHEN 1 THEN 'MIDI' WHEN 2 THEN 'WG' ELSE '' END) AS sample FROM scores)"


@query(
    "j16_sample_groups",
    f"WITH {_NAMES}, m AS (SELECT sample FROM names WHERE sample NOT LIKE '%MIDI'), s AS (SELECT sample AS secondary, left(sample, length(sample) - 4) AS b FROM names WHERE sample LIKE '%MIDI'), o AS (SELECT secondary, coalesce(x.sample, y.sample) AS main FROM s LEFT JOIN m x ON x.sample = b LEFT JOIN m y ON y.sample = concat(b, 'WG')) SELECT m.sample AS main, secondary FROM m LEFT JOIN o ON o.main = m.sample UNION ALL SELECT secondary, NULL FROM o WHERE main IS NULL",
    "scores",
)
def j16(rows: DataFrame) -> DataFrame:
    k = F.col("sample")
    name = F.concat(F.lit("s"), F.floor(k / 2).cast("string"), F.when(k % 4 == 1, "MIDI").when(k % 4 == 2, "WG").otherwise(""))
    return runs.sample_groups(rows.select(name.alias("sample")).distinct())


_TARGET = "CASE WHEN contains(project, 'URGENT') THEN 1 ELSE 0 END"


@query("t6_best_decisions", f"SELECT sample, region, project, score FROM (SELECT *, on_score AS score, row_number() OVER (PARTITION BY sample, region ORDER BY on_score DESC, {_TARGET} DESC, CASE WHEN {_TARGET} = 1 THEN -ord ELSE ord END) AS k FROM scores) WHERE k = 1", "scores")
def t6(rows: DataFrame) -> DataFrame:
    return runs.best_decisions(rows.withColumnRenamed("on_score", "score"), F.col("project").contains("URGENT")).select("sample", "region", "project", "score")


@query(
    "j17_review_decisions",
    f"WITH d AS (SELECT sample, region, seed, project, CASE WHEN {_TARGET} = 1 THEN on_score ELSE off_score END AS score, row_number() OVER (PARTITION BY sample, region ORDER BY CASE WHEN {_TARGET} = 1 THEN on_score ELSE off_score END DESC, {_TARGET} DESC, CASE WHEN {_TARGET} = 1 THEN -ord ELSE ord END) AS k FROM scores), c AS (SELECT sample, count(*) AS raw_reads, count(DISTINCT seed) AS seeds FROM scores GROUP BY sample) SELECT d.sample, region, project, score, raw_reads, seeds FROM d JOIN c ON c.sample = d.sample WHERE k = 1",
    "scores",
)
def j17(rows: DataFrame) -> DataFrame:
    targeted = F.col("project").contains("URGENT")
    scored = rows.withColumn("score", F.when(targeted, F.col("on_score")).otherwise(F.col("off_score")))
    raw = rows.groupBy("sample").agg(F.count(F.lit(1)).alias("raw_reads"), F.count_distinct("seed").alias("seeds"))
    return runs.best_decisions(scored, targeted).join(raw, "sample").select("sample", "region", "project", "score", "raw_reads", "seeds")


@query("j18_consensus_release", "SELECT s.ord, CASE WHEN s.on_score = 1 THEN '-' ELSE s.region END AS seq, p.seed IS NOT NULL AS ok_for_release FROM scores s LEFT JOIN (SELECT DISTINCT sample, seed FROM scores WHERE contains(project, 'URGENT')) p ON p.sample = s.sample AND p.seed = s.seed", "scores")
def j18(rows: DataFrame) -> DataFrame:
    seeds = rows.filter(F.col("project").contains("URGENT")).select("sample", "seed", F.lit(True).alias("ok")).distinct()
    return rows.join(seeds, ["sample", "seed"], "left").select("ord", F.when(F.col("on_score") == 1, "-").otherwise(F.col("region")).alias("seq"), F.coalesce("ok", F.lit(False)).alias("ok_for_release"))


@query("j19_project_regions", "SELECT DISTINCT project, region, seed FROM scores s WHERE NOT EXISTS (SELECT 1 FROM scores x WHERE x.project = s.project AND x.region = s.region AND x.seed = s.seed AND x.on_score = 4)", "scores")
def j19(rows: DataFrame) -> DataFrame:
    key = ["project", "region", "seed"]
    return rows.select(key).distinct().join(rows.filter("on_score = 4").select(key), key, "left_anti")


@query("j23_mixtures_with_mismatches", f"WITH {_CONS} SELECT refname, pos FROM cons c WHERE cutoff = '0.100' AND upper(base) IN ('R', 'Y', 'S', 'W', 'K', 'M', 'B', 'D', 'H', 'V', 'N') AND EXISTS (SELECT 1 FROM cons m WHERE m.refname = c.refname AND m.pos = c.pos AND m.cutoff = 'MAX' AND upper(m.base) = 'A')", "aligned")
def j23(aligned: DataFrame) -> DataFrame:
    bases = counts.consensus_bases(counts.position_bases(aligned), ("0.100", "MAX"))
    mixtures = bases.filter(F.col("cutoff") == "0.100").filter(F.upper("base").isin(*"RYSWKMBDHVN")).select("refname", "pos")
    return mixtures.join(bases.filter("cutoff = 'MAX' AND upper(base) = 'A'"), ["refname", "pos"], "left_semi")


@query("j25_reconciled_references", "SELECT status, count(*) AS n FROM (SELECT CASE WHEN a.id IS NULL THEN 'unused' WHEN b.id IS NULL THEN 'missing' WHEN a.v = b.v THEN 'matching' ELSE 'changed' END AS status FROM (SELECT doc_id AS id, seq AS v FROM seqs WHERE doc_id % 5 <> 0) a FULL JOIN (SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN letters ELSE seq END AS v FROM seqs WHERE doc_id % 3 <> 0) b ON a.id = b.id) GROUP BY status", "seqs")
def j25(seqs: DataFrame) -> DataFrame:
    ours = seqs.filter("doc_id % 5 <> 0").select(F.col("doc_id").alias("id"), F.col("seq").alias("v"))
    theirs = seqs.filter("doc_id % 3 <> 0").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 7 == 0, F.col("letters")).otherwise(F.col("seq")).alias("v"))
    return runs.reconcile(ours, theirs, "id", "v")


@query("j28_overrides", "SELECT ord, CASE WHEN ord % 6 = 0 THEN 'OVERRIDE' ELSE project END AS project FROM scores", "scores")
def j28(rows: DataFrame) -> DataFrame:
    return runs.overridden(rows.select("ord", "project"), rows.filter("ord % 6 = 0").select("ord", F.lit("OVERRIDE").alias("project")), "ord", "project")


@query("j29_primer_partners", "SELECT a.pair_id, CASE WHEN b.seq IS NULL THEN 'missing' ELSE 'different' END AS problem FROM reads a LEFT JOIN reads b ON b.pair_id = a.pair_id AND b.mate = 2 WHERE a.mate = 1 AND (b.seq IS NULL OR b.seq <> translate(reverse(a.seq), 'ACGT', 'TGCA'))", "reads")
def j29(reads: DataFrame) -> DataFrame:
    from readloom.functions.seq import reverse_complement

    a = reads.filter("mate = 1").select("pair_id", reverse_complement("seq").alias("want"))
    b = reads.filter("mate = 2").select("pair_id", "seq")
    joined = a.join(b, "pair_id", "left")
    return joined.filter(F.col("seq").isNull() | (F.col("seq") != F.col("want"))).select("pair_id", F.when(F.col("seq").isNull(), "missing").otherwise("different").alias("problem"))


@query("t9_every_nth_run", "SELECT run_id FROM (SELECT run_id, row_number() OVER (ORDER BY run_id) - 1 AS k FROM (SELECT DISTINCT run_id FROM runs)) WHERE k % 10 = 0", "runs")
def t9(rows: DataFrame) -> DataFrame:
    return runs.every_nth(rows, "run_id", 10)


@query("t11_latest_runs", "SELECT app, max(run_id) AS run_id FROM runs WHERE depth > 10 GROUP BY app", "runs")
def t11(rows: DataFrame) -> DataFrame:
    return rows.filter("depth > 10").groupBy("app").agg(F.max("run_id").alias("run_id"))


@query("t12_running_best", "SELECT sample, ord, score FROM (SELECT sample, ord, on_score AS score, greatest(1, coalesce(max(on_score) OVER (PARTITION BY sample ORDER BY ord DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1)) AS b FROM scores) WHERE score >= b", "scores")
def t12(rows: DataFrame) -> DataFrame:
    return runs.running_best(rows.select("sample", "ord", F.col("on_score").alias("score")), ["sample"])


@query("t13_app_order", "SELECT app, count(*) AS n, CASE app WHEN 'NO' THEN 1 WHEN 'AF' THEN 2 ELSE 3 END AS place FROM runs GROUP BY app", "runs")
def t13(rows: DataFrame) -> DataFrame:
    return runs.in_order(rows.groupBy("app").agg(F.count(F.lit(1)).alias("n")), "app", ["NO", "AF"])


@query("t15_last_stage_counts", "SELECT sample, last(depth ORDER BY run_id, line, run_time, depth) AS depth FROM runs WHERE app LIKE 'A%' GROUP BY sample", "runs")
def t15(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("app").startswith("A")).groupBy("sample").agg(F.max(F.struct("run_id", "line", "run_time", "depth"))["depth"].alias("depth"))


@query("u1_union", "SELECT app, sample, depth, NULL AS line FROM runs WHERE app = 'AF' UNION ALL SELECT app, sample, NULL, line FROM runs WHERE app = 'NO'", "runs")
def u1(rows: DataFrame) -> DataFrame:
    return rows.filter("app = 'AF'").select("app", "sample", "depth").unionByName(rows.filter("app = 'NO'").select("app", "sample", "line"), allowMissingColumns=True)


@query("u2_missing_samples", "SELECT c_custkey AS sample FROM customer WHERE c_custkey NOT IN (SELECT sample FROM scores WHERE region = 'R1') AND NOT regexp_matches(CAST(c_custkey AS VARCHAR), '7$')", "customer", "scores")
def u2(customer: DataFrame, rows: DataFrame) -> DataFrame:
    expected = customer.select(F.col("c_custkey").alias("sample"))
    return expected.join(rows.filter("region = 'R1'"), "sample", "left_anti").filter(~F.col("sample").cast("string").rlike("7$"))


@query("u3_common_samples", "SELECT concat(sample, line) AS sample FROM runs WHERE app = 'AF' AND depth > 40 INTERSECT SELECT concat(sample, line) FROM runs WHERE app = 'NO' AND depth < 9", "runs")
def u3(rows: DataFrame) -> DataFrame:
    named = rows.withColumn("sample", F.concat("sample", "line"))
    return named.filter("app = 'AF' AND depth > 40").select("sample").intersect(named.filter("app = 'NO' AND depth < 9").select("sample"))


@query("u4_filled_regions", "SELECT g.sample, g.region, n FROM (SELECT sample, region FROM (SELECT DISTINCT sample FROM scores), (SELECT DISTINCT region FROM scores)) g LEFT JOIN (SELECT sample, region, count(*) AS n FROM scores GROUP BY ALL) s ON s.sample = g.sample AND s.region = g.region", "scores")
def u4(rows: DataFrame) -> DataFrame:
    have = rows.groupBy("sample", "region").agg(F.count(F.lit(1)).alias("n"))
    regions = rows.select("region").distinct()  # a configured list of a few names
    expected = rows.select("sample").distinct().join(F.broadcast(regions))
    return runs.filled(have, expected, ["sample", "region"])


@query("u5_filtered_references", "SELECT doc_id, CASE WHEN k > 1 THEN 'duplicate' WHEN contains(letters, 'idiot') THEN 'excluded' WHEN NOT regexp_matches(lang, '^[de]') THEN 'no subtype' ELSE 'kept' END AS reason FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY doc_id) AS k FROM seqs)", "seqs")
def u5(seqs: DataFrame) -> DataFrame:
    marked = counts.ranked(seqs, ["seq"], ["doc_id"])
    reason = F.when(F.col("rank") > 0, "duplicate").when(F.col("letters").contains("idiot"), "excluded").when(~F.col("lang").rlike("^[de]"), "no subtype").otherwise("kept")
    return marked.select("doc_id", reason.alias("reason"))


@query("u7_well_covered", "SELECT DISTINCT sample, region FROM scores WHERE on_score = 4", "scores")
def u7(rows: DataFrame) -> DataFrame:
    return rows.filter("on_score = 4").select("sample", "region").distinct()


@query("u8_excluded_seeds", "SELECT ord, seed FROM scores WHERE seed NOT IN (SELECT DISTINCT seed FROM scores WHERE contains(project, 'LOW') AND seed <> 'seed1')", "scores")
def u8(rows: DataFrame) -> DataFrame:
    excluded = rows.filter(F.col("project").contains("LOW") & (F.col("seed") != "seed1")).select("seed").distinct()
    return rows.join(excluded, "seed", "left_anti").select("ord", "seed")


_CALLS = "calls AS (SELECT sample, CASE WHEN max(on_score) = 4 THEN 'X4' ELSE 'R5' END AS final, avg(on_score) * 10 AS x4, max(ord) % 3 AS k FROM scores GROUP BY sample)"


@query("c1_call_changes", f"WITH {_CALLS} SELECT sample, final AS before, f2 AS after FROM (SELECT *, CASE WHEN k = 0 THEN 'X4' ELSE final END AS f2, x4 + k AS x2 FROM calls) WHERE final <> f2 OR abs(x4 - x2) >= 2", "scores")
def c1(rows: DataFrame) -> DataFrame:
    calls = rows.groupBy("sample").agg(F.when(F.max("on_score") == 4, "X4").otherwise("R5").alias("final"), (F.avg("on_score") * 10).alias("x4"), (F.max("ord") % 3).alias("k"))
    after = calls.select("sample", F.when(F.col("k") == 0, "X4").otherwise(F.col("final")).alias("final"), (F.col("x4") + F.col("k")).alias("x4"))
    return runs.call_changes(calls, after)


@query(
    "c2_score_changes",
    "WITH a AS (SELECT sample, project, region, nullif(max(on_score), 1) AS s FROM scores WHERE ord % 2 = 0 OR ord % 5 = 0 GROUP BY ALL), b AS (SELECT sample, project, region, nullif(max(on_score), 1) AS s FROM scores WHERE ord % 2 = 1 OR ord % 5 = 0 GROUP BY ALL), c AS (SELECT sample, count(*) > 10 AS changed FROM scores GROUP BY sample) SELECT d.*, CASE WHEN changed THEN 'counts' ELSE 'plain' END AS kind FROM (SELECT sample, project, region, a.s AS before, b.s AS after FROM a FULL JOIN b USING (sample, project, region) WHERE a.s IS DISTINCT FROM b.s) d LEFT JOIN c USING (sample)",
    "scores",
)
def c2(rows: DataFrame) -> DataFrame:
    scored = rows.withColumnRenamed("on_score", "score")
    counted = rows.groupBy("sample").agg((F.count(F.lit(1)) > 10).alias("changed"))
    return runs.score_changes(scored.filter("ord % 2 = 0 OR ord % 5 = 0"), scored.filter("ord % 2 = 1 OR ord % 5 = 0"), counted)


_TWO = "two AS (SELECT a.ord, a.seq AS s1, b.seq AS s2 FROM aligned a JOIN aligned b ON b.ord = a.ord + 1)"


@query("c5_padded_distances", f"WITH {_TWO}, p AS (SELECT ord, CAST(greatest(length(s1), length(s2)) AS INT) AS n, s1, s2 FROM two), d AS (SELECT ord, n, levenshtein(rpad(s1, n, '-'), rpad(s2, n, '-')) AS distance FROM p) SELECT ord, distance, CASE WHEN n > 0 THEN round(100 * distance / n, 6) ELSE 0 END AS pct FROM d", "aligned")
def c5(aligned: DataFrame) -> DataFrame:
    distance, share = runs.padded_distance(F.col("s1"), F.col("s2"))
    return _two(aligned).select("ord", distance.alias("distance"), F.round(share, 6).alias("pct"))


def _two(aligned: DataFrame) -> DataFrame:
    return aligned.select("ord", F.col("seq").alias("s1")).join(aligned.select((F.col("ord") - 1).alias("ord"), F.col("seq").alias("s2")), "ord")


@query("c6_change_kinds", "SELECT kind, count(*) AS n FROM (SELECT CASE WHEN s1 = s2 THEN NULL WHEN replace(s1, '-', '') = replace(s2, '-', '') THEN 'deletions' WHEN contains(s2, s1) THEN 'extended' ELSE 'other' END AS kind FROM (SELECT seq AS s1, CASE ord % 4 WHEN 0 THEN replace(seq, '-', '') WHEN 1 THEN concat('A', seq) WHEN 2 THEN seq ELSE reverse(seq) END AS s2 FROM aligned)) GROUP BY kind", "aligned")
def c6(aligned: DataFrame) -> DataFrame:
    k, s = F.col("ord") % 4, F.col("seq")
    after = F.when(k == 0, F.replace(s, F.lit("-"), F.lit(""))).when(k == 1, F.concat(F.lit("A"), s)).when(k == 2, s).otherwise(F.reverse(s))
    return aligned.select(runs.consensus_change(s, after).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("c7_well_covered_consensus", "SELECT ord, region FROM scores s WHERE EXISTS (SELECT 1 FROM scores c WHERE c.sample = s.sample AND c.region = s.region AND c.on_score = 4)", "scores")
def c7(rows: DataFrame) -> DataFrame:
    return rows.join(rows.filter("on_score = 4").select("sample", "region").distinct(), ["sample", "region"], "left_semi").select("ord", "region")


@query("c8_version_counts", "SELECT app, line AS version, count(*) AS n, max(run_id) AS latest FROM runs GROUP BY app, line", "runs")
def c8(rows: DataFrame) -> DataFrame:
    return rows.groupBy("app", F.col("line").alias("version")).agg(F.count(F.lit(1)).alias("n"), F.max("run_id").alias("latest"))


@query(
    "c4_significant_changes",
    f"""WITH {_CONS}, wide AS (SELECT refname, pos, {', '.join(f"coalesce(sum(n) FILTER (WHERE base = '{x}'), 0) AS {x}" for x in 'ACGT')} FROM long GROUP BY ALL), m AS (SELECT c.refname, c.pos, coverage, CASE WHEN coverage < 100 THEN 'x' ELSE base END AS b, A, C, G, T FROM cons c JOIN wide w ON w.refname = c.refname AND w.pos = c.pos WHERE cutoff = '0.250'),
    j AS (SELECT coalesce(a.pos, b.pos) AS pos, coalesce(a.b, '') AS b1, coalesce(b.b, '') AS b2, coalesce(a.coverage, 0) AS c1, coalesce(b.coverage, 0) AS c2, {', '.join(f"coalesce({t}.{x}, 0) AS n{x}{n}" for t, n in (('a', 1), ('b', 2)) for x in 'ACGT')} FROM (SELECT * FROM m WHERE refname = 'ref0') a FULL JOIN (SELECT * FROM m WHERE refname = 'ref1') b ON a.pos = b.pos),
    f AS (SELECT *, {', '.join(f"CASE WHEN b{n} IN ('x', '-', '') THEN false WHEN b{n} NOT IN ('A', 'C', 'G', 'T') THEN true WHEN c1 = 0 OR c2 = 0 THEN true ELSE abs(CASE b{n} WHEN 'A' THEN nA1 WHEN 'C' THEN nC1 WHEN 'G' THEN nG1 ELSE nT1 END / c1 - CASE b{n} WHEN 'A' THEN nA2 WHEN 'C' THEN nC2 WHEN 'G' THEN nG2 ELSE nT2 END / c2) > 0.05 END AS m{n}" for n in (1, 2))} FROM j)
    SELECT pos, b1 AS old_base, b2 AS new_base FROM f WHERE b1 <> b2 AND (m1 OR m2 OR ((b1 = 'x' OR b2 = 'x') AND (c1 < c2 / 2 OR c2 < c1 / 2)))""",
    "aligned",
)
def c4(aligned: DataFrame) -> DataFrame:
    """References stand for the two releases of a sample; at this cutoff some of their bases differ."""
    long = counts.position_bases(aligned)
    wide = counts.pileup(long).drop("N", "del", "coverage")
    called = counts.consensus_bases(long, ("0.250",)).withColumn("base", F.when(F.col("coverage") < 100, "x").otherwise(F.col("base")))
    both = called.join(wide, ["refname", "pos"]).drop("cutoff")
    old, new = (both.filter(F.col("refname") == r).drop("refname") for r in ("ref0", "ref1"))
    return runs.significant_changes(old, new, ["pos"])


@query("s12_properties", "SELECT app, max(CASE WHEN line = 1 THEN n END) AS k1, max(CASE WHEN line = 2 THEN n END) AS k2, max(CASE WHEN line = 9 THEN n END) AS k9 FROM (SELECT app, line, count(*) AS n FROM runs GROUP BY ALL) GROUP BY app", "runs")
def s12(rows: DataFrame) -> DataFrame:
    props = rows.groupBy("app", F.concat(F.lit("k"), "line").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    return runs.properties_table(props, ["k1", "k2", "k9"])
