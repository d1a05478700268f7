"""Work that grows with the input: alike rows are counted before they are parted, distances go many at a call."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from readloom.functions import cigar
from readloom.operators import distances, edits, groups, kmers, pairing, runs, segments, summaries


def slow(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_distances_of_many_pairs():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choices("ACGTN-é\U0001f600", k=n))
    one = [text(rng.choice((0, 1, 63, 64, 65, 128, 130, 200))) for _ in range(150)]
    two = [a[:9] + text(2) + a[12:] if i % 3 else text(rng.randrange(150)) for i, a in enumerate(one)]
    want = [slow(a, b) for a, b in zip(one, two, strict=True)]
    assert edits.distances(one, two).tolist() == want
    assert [edits._one(*sorted(p, key=len)) for p in zip(one, two, strict=True) if all(p)] == [d for *p, d in zip(one, two, want, strict=True) if all(p)]


def test_nearest_of_short_texts_that_share_all_their_parts(spark):
    """Short texts within most edits of all others don't go through a join on parts of one letter; a name met twice is its own once."""
    rng = random.Random(4)
    rows = [(i, f"k{i % 3}", "".join(rng.choices("ACGT", k=rng.randrange(20, 60)))) for i in range(60)]
    rows += [(60, "k0", rows[0][2]), (61, None, rows[0][2]), (62, None, ""), (63, "k1", None)]
    df = spark.createDataFrame(rows, "id long, kind string, seq string")
    out = distances.nearest(df, df.withColumnRenamed("id", "reference"), 32)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
    for r in out.collect():
        _, kind, seq = rows[r.id]
        near = sorted((slow(seq, t), i, k) for i, k, t in rows if i != r.id and None not in (seq, t))
        near = [x for x in near if x[0] <= 32]
        own = [x for x in near if x[2] == kind]
        assert (r.distance, r.nearest) == (near[0][:2] if near else (None, None))
        assert (r.own_distance, r.own_nearest) == (own[0][:2] if own else (None, None))


def test_padded_distances_go_many_at_a_call(spark):
    df = spark.createDataFrame([("ACGT", "AC"), ("", ""), (None, "A"), ("A", "T")], "a string, b string")
    out = df.select(*(c.alias(n) for c, n in zip(runs.padded_distance(F.col("a"), F.col("b")), ("d", "share"), strict=True)))
    assert "levenshtein" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in out.collect()] == [(2, 50.0), (0, 0.0), (None, None), (1, 100.0)]


def test_kmers_are_counted_in_the_task(spark):
    texts = [("x", "ACGTACGTNACGRACG"), ("x", "ACG"), ("y", "AC"), (None, "TTTTT"), ("x", None), ("z", "é" * 4)]
    out = kmers.entropy(spark.createDataFrame(texts, "k string, seq string"), "k", 3)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    want = {}
    for key in {k for k, _ in texts}:
        n = Counter(s[i : i + 3] for k, s in texts if k == key and s for i in range(len(s) - 2) if "N" not in s[i : i + 3])
        if n:
            want[key] = sum(-c / n.total() * math.log2(c / n.total()) for c in n.values())
    assert {r.k: round(r.entropy, 9) for r in out.collect()} == {k: round(h, 9) for k, h in want.items()}


SAM = [("a", 99, "r", 5, "2S3M1D2M", "ACGTACG"), ("b", 99, "r", 5, "2S3M1D2M", "TTTTTTT"), ("c", 99, "r", 7, "2M2I2M1S", "ACGTACG"), ("c", 147, "r", 7, "3M", "ACGT"), ("d", 99, "r", 5, "2S3M1D2M", None)]


def test_alignments_are_parsed_once_each(spark):
    sam = spark.createDataFrame([(*r, r[5]) for r in SAM], "qname string, flag int, rname string, pos int, cigar string, seq string, qual string")
    counted = cigar.counted_tokens(sam, ["rname"])
    assert {r.reads for r in counted.filter("q0 = 2 AND op = 'M' AND pos = 5").collect()} == {2} and counted.count() == 8
    plain = summaries.genome_coverage(cigar.tokens(sam, ["rname"]))
    assert sorted(map(tuple, summaries.genome_coverage(counted, weight="reads").collect())) == sorted(map(tuple, plain.collect()))
    bases = cigar.aligned_bases(cigar.tokens(sam, ["rname"]), ["rname"]).groupBy("rname", "ref_pos").count()
    assert sorted(map(tuple, cigar.coverage(counted, ["rname"]).collect())) == sorted(map(tuple, bases.collect()))


def test_alike_pairs_are_counted_before_their_clips(spark):
    rows = [("a", 5, "2S3M"), ("a", 9, "3M2S"), ("b", 5, "2S3M"), ("b", 9, "3M2S"), ("c", 9, "3M2S"), ("c", 11, "2S3M"), ("d", 5, "2S3M"), ("e", 5, "2S3M"), ("e", 5, "*"), ("f", 5, "2S3M"), ("f", 5, "9M")]
    out = pairing.clip_counts(spark.createDataFrame([(q, "r", p, c, "ACGTA") for q, p, c in rows], "qname string, rname string, pos int, cigar string, seq string"))
    want = Counter()
    for places in ((({3, 4, 12, 13}), {5, 6, 7, 9, 10, 11}), (({3, 4, 12, 13}), {5, 6, 7, 9, 10, 11}), (({12, 13, 9, 10}), {9, 10, 11, 12, 13}), (({3, 4}), {5, 6, 7})):
        want.update(places[0] - places[1])
    assert {r.ref_pos: r.n for r in out.collect()} == dict(want)


def test_letters_are_counted_by_stretches(spark):
    df = spark.createDataFrame([("r", 0, "ACGTAC-"), ("r", 2, "GTNAA"), ("r", 2, ""), ("s", -3, "é")], "rname string, start long, letters string")
    want = Counter((r.rname, r.start + i, c) for r in df.collect() for i, c in enumerate(r.letters))
    assert {(r.rname, r.ref_pos, r.base): r.n for r in segments.letter_counts(df).collect()} == want


def test_concordance_of_blocks(spark):
    rng = random.Random(5)
    seed = "".join(rng.choices("ACGTN", k=120))
    parts = [(c, "r", at, "".join(x if rng.random() < 0.8 else rng.choice("ACGTN-") for x in seed[at : at + n])) for c in range(5) for at, n in ((rng.randrange(100), rng.randrange(1, 70)) for _ in range(3))]
    df = spark.createDataFrame([*parts, (9, "r", 3, "--")], "contig long, rname string, start long, letters string")
    known = spark.createDataFrame([("r", i, x) for i, x in enumerate(seed) if i % 10], "rname string, ref_pos long, expected string")
    regions = [("one", 0, 31), ("two", 20, 97), ("far", 400, 440)]
    want = {}
    for c in {p[0] for p in parts}:
        agrees = {}
        for _, _, at, text in (p for p in parts if p[0] == c):
            for i, x in enumerate(text, at):
                if x != "-":
                    agrees[i] = agrees.get(i, False) or bool(i % 10 and i < 120 and seed[i] == x)
        for name, a, b in regions:
            held = [v for i, v in agrees.items() if a <= i < b]
            want[c, name] = (round(100 * sum(held) / len(held), 6) if held else 0.0, round(100 * len(held) / (b - a), 6))
    out = segments.seed_concordance(df, known, spark.createDataFrame(regions, "region string, start long, end long"))
    assert {(r.contig, r.region): (round(r.pct_concordance, 6), round(r.pct_covered, 6)) for r in out.collect()} == want


def test_drifted_references_need_no_matrix_a_pair(spark, monkeypatch):
    monkeypatch.setattr(distances.F, "levenshtein", None)
    rows = [("s", "a", "ACGTACGTAA", 1), ("s", "b", "TTTTGGGG", 2), ("s", "c", None, 3)]
    seeds = [("s", "a", "TTTTGGGA"), ("s", "b", "ACGTACGTAC"), ("s", "c", "A")]
    out = distances.drop_drifted(spark.createDataFrame(rows, "sample string, name string, seq string, reads long"), spark.createDataFrame(seeds, "sample string, name string, seq string"))
    found = {r.name: tuple(r)[2:] for r in out.collect()}
    near = lambda x, y: slow({n: s or "" for _, n, s, _ in rows}[x], {n: s for _, n, s in seeds}[y])
    assert found == {"a": (near("a", "a"), near("a", "b"), "b", False), "b": (near("b", "b"), near("b", "a"), "a", True), "c": (1, None, None, False)}


def test_run_statistics_hold_a_bounded_number_of_rows_a_task(spark, monkeypatch):
    """Groups of (run, sample) are as many as rows here: tasks grow in number, not in size."""
    rows = spark.range(4000).select((F.col("id") % 1000).alias("run"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("s"), F.col("id") % 3000)).alias("sample"), F.when(F.col("id") % 5 == 0, "x").otherwise((F.col("id") % 4).cast("string")).alias("depth"))
    monkeypatch.setattr(groups, "ROWS_A_TASK", 100)
    out = runs.run_statistics(rows, ["run"], ["depth"], "sample")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and plan.split("RepartitionByExpression")[1].split("\n")[0].endswith(", 40")
    found = {r.run: tuple(r)[1:] for r in out.collect()}
    for run in range(1000):
        ids = range(run, 4000, 1000)
        depths, samples = [i % 4 for i in ids if i % 5], [i % 3000 for i in ids if i % 7]
        assert found[run] == (sum(depths) / len(depths) if depths else None, len(samples), len({*samples}), len(samples) - len({*samples}))
    assert len(found) == 1000 and runs.run_statistics(rows.limit(0), ["run"], ["depth"], "sample").count() == 0
