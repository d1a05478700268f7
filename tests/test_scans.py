import random

from pyspark.sql import functions as F

from readloom.operators import intervals, scans
from readloom.sources import alignments, files


def laid_in(spark, rows, schema, key, order, ranges=7):
    """Laid over so many ranges, whatever adaptive execution would make of so few rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        return scans.laid(spark.createDataFrame(rows, schema), key, order)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_key_over_many_ranges(spark):
    """All rows but a few have one key; values are carried over ranges, empty (null) ones too."""
    rng = random.Random(1)
    rows = [("hot", i, rng.choice((None, rng.randrange(-50, 50)))) for i in range(400)] + [("cold", 3, 5), (None, 1, 2), (None, 9, None)]
    placed = laid_in(spark, rows, "k string, i int, v int", ["k"], ["i"])
    assert placed.filter("k = 'hot'").select("_range").distinct().count() > 4
    folds = {"sum": lambda x: sum(x) if x else None, "max": lambda x: max(x, default=None), "min": lambda x: min(x, default=None)}
    for own in (True, False):
        for after in (True, False):
            out = scans.running(placed, ["k"], ["i"], {f: (f, F.col("v")) for f in ("sum", "max", "min", "nearest")}, own, after).collect()
            assert len(out) == len(rows)
            for r in out:
                upto = sorted(i for k, i, _ in rows if k == r.k and ((i > r.i if after else i < r.i) or own and i == r.i))
                values = {i: v for k, i, v in rows if k == r.k}
                seen = [values[i] for i in upto if values[i] is not None]
                assert {f: r[f] for f in folds} == {f: g(seen) for f, g in folds.items()}
                assert r.nearest == (seen[0 if after else -1] if seen else None)


def merged(spans):
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def is_covered(x, left):
    """(start, end, reads, id), as the rule has it."""
    others = [y for y in left if y[3] != x[3] and y[0] <= x[1] and y[1] >= x[0]]
    cover = merged([y[:2] for y in others])
    if any(a < x[0] and b >= x[1] or a <= x[0] and b > x[1] for a, b in cover):
        return True
    known = all(y[2] is not None for y in [*others, x])
    return any([a, b] == [x[0], x[1]] for a, b in cover) and known and sum(y[2] for y in others) > x[2]


def one_at_a_time(spans):
    left = list(spans)
    while True:
        by_reads = all(x[2] is not None for x in left)
        for x in sorted(left, key=lambda x: x[2] if by_reads else x[1] - x[0]):
            if is_covered(x, left):
                left.remove(x)
                break
        else:
            return [x[3] for x in left]


SPANS = "ref string, id long, r_st long, r_ei long, reads long"


def test_cover_goes_as_in_the_loop_over_all(spark):
    """Many samples of several islands, where unknown reads change the order until the last of them goes."""
    rng = random.Random(2)
    groups = {"probe": [(0, 10, 1, 1), (1, 12, 2, 2), (0, 2, 10, 3), (9, 12, 10, 4), (3, 4, None, 5)]}
    for g in range(150):
        spans, base = [], 0
        for _ in range(rng.choice((1, 2, 3))):
            for _ in range(rng.randrange(1, 7)):
                a = base + rng.randrange(8)
                spans.append((a, a + rng.randrange(9), rng.choice((None, 1, 2, 3, 4)) if rng.random() < 0.5 else rng.randrange(1, 5), len(spans)))
            base += 40
        groups[f"g{g}"] = spans
    rows = [(g, i, a, b, n) for g, spans in groups.items() for a, b, n, i in spans]
    out = intervals.without_covered(spark.createDataFrame(rows, SPANS), ["ref"]).collect()
    found = {g: sorted(r.id for r in out if r.ref == g) for g in groups}
    assert found == {g: sorted(one_at_a_time(spans)) for g, spans in groups.items()}
    assert found["probe"] == [2, 3]


def test_cover_seen_at_once_matches_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for g in range(40):
        for i in range(rng.randrange(1, 12)):
            a = rng.randrange(25)
            rows.append((f"g{g}", 100 * g + i, a, a + rng.randrange(12), rng.choice((None, 1, 2, 5))))
    out = {r.id for r in intervals.covered_by_others(spark.createDataFrame(rows, SPANS)).collect()}
    assert out == {i for g, i, a, b, n in rows if is_covered((a, b, n, i), [(y[2], y[3], y[4], y[1]) for y in rows if y[0] == g])}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SPANS)
    assert intervals.without_covered(none, ["ref"]).count() == intervals.covered_by_others(none).count() == intervals.merge_intervals(none).count() == 0


def test_a_region_reads_few_of_the_clustered_rows(spark, tmp_path):
    rng = random.Random(4)
    cigars = ("50M", "20M10D30M", "5S40M3I2M", "*", "10M2000D40M")
    rows = [(f"q{i}", f"r{rng.randrange(3)}", rng.randrange(1, 60_000), rng.choices(cigars, (50, 20, 20, 5, 1))[0], "".join(rng.choices("ACGT", k=50))) for i in range(20_000)]
    alignments.write_clustered(spark.createDataFrame(rows, "qname string, rname string, pos int, cigar string, seq string"), str(tmp_path / "a"), 8_192)
    spans = {"50M": 50, "20M10D30M": 60, "5S40M3I2M": 42, "10M2000D40M": 2050}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = alignments.reads_in_region(spark, str(tmp_path / "a"), "r1", 30_000, 30_100)
        plan = found._jdf.queryExecution().executedPlan()
        got = sorted(r.qname for r in found.collect())
        scan, read = plan, None
        while read is None:
            read = scan.metrics().get("numOutputRows").get().value() if "Scan" in scan.nodeName() else None
            scan = scan.children().head() if read is None else scan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == sorted(q for q, r, p, c, _ in rows if r == "r1" and c != "*" and p <= 30_100 and p + spans[c] - 1 >= 30_000) and len(got) > 10
    assert read < 4_000, read
    ordered = spark.read.parquet(str(tmp_path / "a")).withColumn("file", F.input_file_name()).collect()
    assert all((a.rname, a.pos) <= (b.rname, b.pos) for a, b in zip(ordered, ordered[1:], strict=False) if a.file == b.file) and len(ordered) == sum(c != "*" for *_, c, _ in rows)


def test_scores_are_read_from_tags(spark, tmp_path):
    line = "q\t99\tr\t5\t44\t4M\t=\t0\t0\tACGT\tIIII"
    (tmp_path / "x.sam").write_text(f"@SQ\tSN:r\n{line}\n{line}\tNM:i:3\tAS:i:-7\n{line}\tXS:Z:AS:i:9\tAS:i:12\tYS:i:1\n")
    out = files.read_sam(spark, str(tmp_path / "x.sam"))
    assert sorted((r.qname, r.pos, r.qual, str(r.score)) for r in out.collect()) == [("q", 5, "IIII", "-7"), ("q", 5, "IIII", "12"), ("q", 5, "IIII", "None")]
    files.write_sam(out, str(tmp_path / "y"))
    assert sorted(str(r.score) for r in files.read_sam(spark, str(tmp_path / "y")).collect()) == ["-7", "12", "None"]


def test_frames_never_reach_to_the_end(spark):
    """Spark goes through such a frame anew for each row, which takes quadratic time in a range."""
    placed = laid_in(spark, [("a", i, i) for i in range(50)], "k string, i int, v int", ["k"], ["i"])
    for own in (True, False):
        out = scans.running(placed, ["k"], ["i"], {"s": ("sum", F.col("v")), "n": ("nearest", F.col("v"))}, own, after=True)
        assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
