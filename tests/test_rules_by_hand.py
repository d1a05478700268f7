"""Edge rules on rows made by hand."""

import collections
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from readloom.functions import cigar, names, scores, seq
from readloom.operators import counts, intervals, kmers, pairing, resist, runs, segments, windows
from readloom.sources import files


def column(spark, expr, *values):
    df = spark.createDataFrame([values], [f"v{i}" for i in range(len(values))])
    return df.select(expr(*(F.col(c) for c in df.columns)).alias("x")).first()["x"]


def test_complements(spark):
    assert column(spark, seq.reverse_complement_all, "ACRW") == "SYGT"
    assert column(spark, seq.reverse_complement, "ACxN") == "NxGT"
    with pytest.raises(PySparkException):
        column(spark, seq.reverse_complement_all, "AZ")


def test_translation(spark):
    df = spark.createDataFrame([("TGTATR---A-GA--TT",), ("",), ("NNN",)], "seq string")
    out = [(r.amino, r.codons, r.ambiguous) for r in seq.translate(df).collect()]
    assert sorted(out) == sorted([("C?-??", 5, 2), ("", 0, 0), ("?", 1, 1)])


def test_translation_options(spark):
    df = spark.createDataFrame([("TGTATR---ctnTAGX", 1), ("", 2), (None, 3), ("EFA0TT", 4)], "seq string, n int").repartition(3)

    def of(**options):
        return {r.n: (r.amino, r.codons, r.most_aminos, r.ambiguous) for r in seq.translate(df, **options).collect()}

    assert of() == {1: ("C?-L*", 5, 2, 1), 2: ("", 0, 0, 0), 3: ("", 0, 0, 0), 4: ("??", 2, 1, 0)}
    assert of(list_ambiguous=True)[1][0] == "C[IM]-L*" and of(resolve=True)[1][0] == "CI-L*"
    assert of(return_list=True)[1][0] == [["C"], ["I", "M"], ["-"], ["L"], ["*"]] and of(return_list=True)[2][0] == []
    assert of(offset=2)[1][1] == 6 and of(offset=2)[1][0][0] == "?" and of(offset=1, list_ambiguous=True)[1][0].startswith("[")


@pytest.mark.parametrize(
    ("s1", "q1", "s2", "q2", "want"),
    [
        ("ACGT", "IIII", "ACGT", "IIII", "ACGT"),
        ("AC", "II", "AG", "I5", "AC"),  # the better base stays
        ("AC", "I5", "AG", "II", "AG"),
        ("AC", "II", "AG", "IH", "AN"),  # too close
        ("AC", "0I", "AC", "0I", "NC"),  # neither exceeds the cutoff
        ("AC", "II", "----GT", "!!!!II", "ACnnGT"),  # a gap between mates
        ("A-C", "I I", "A-C", "I I", "A-C"),  # a deletion is no N
        ("----GT", "!!!!II", "AC", "II", "ACnnGT"),  # the shorter counts as the first
    ],
)
def test_merged_mates(spark, s1, q1, s2, q2, want):
    assert column(spark, pairing.merged, s1, q1, s2, q2) == want


def test_aligned_strings(spark):
    r = column(spark, lambda s, q, p, c: cigar.aligned_strings(s, q, p.cast("int"), c), "AACGTTGG", "ABCDEFGH", 3, "2S2M2D1M1I2M")
    assert (r["seq"], r["qual"]) == ("--CG--TGG", "!!CD  EGH")


def test_clips_and_insertions(spark):
    df = spark.createDataFrame([("q", 5, "3S4M2I1M2S", "AAACCCCGGTAA", "IIIIIIIIIIII")], "k string, pos int, cigar string, seq string, qual string")
    found = cigar.tokens(df, ["k"])
    assert sorted(r.ref_pos for r in cigar.clipped_positions(found, ["k"]).collect()) == [2, 3, 4, 10, 11]
    assert [(r.ref_pos, r.insert) for r in cigar.insertions(found, ["k"]).collect()] == [(8, "GG")]
    assert cigar.tokens(df.withColumn("cigar", F.lit("5M")), ["k"]).count() == 0


def test_consensus_ties_and_deletions(spark):
    rows = [("r", 1, "A", 50), ("r", 1, "C", 50), ("r", 2, "-", 60), ("r", 2, "T", 60), ("r", 3, "-", 9), ("r", 4, "N", 3)]
    out = {r.pos: r.base for r in counts.consensus_bases(spark.createDataFrame(rows, "refname string, pos long, base string, n long"), ("MAX",)).collect()}
    assert out == {1: "M", 2: "t", 3: "-", 4: "N"}


def test_consensus_sequence_masks(spark):
    rows = [("r", p, "MAX", c, b) for p, c, b in ((1, 5, "A"), (2, 200, "C"), (3, 1, "G"), (4, 200, "T"), (5, 2, "A"))]
    r = counts.consensus_sequences(spark.createDataFrame(rows, "refname string, pos long, cutoff string, coverage long, base string")).first()
    assert (r.seed_offset, r.sequence) == (1, "CxT")


def test_intervals_merge_across_buckets(spark):
    rows = [(1, "a", 1, 990, 1), (2, "a", 991, 1500, 1), (3, "a", 1502, 1600, 1), (4, "b", 5, 9, 1), (5, "a", 100, 200, 1)]
    df = spark.createDataFrame(rows, "id long, ref string, r_st long, r_ei long, reads long")
    assert sorted(map(tuple, intervals.merge_intervals(df).collect())) == [("a", 1, 1500), ("a", 1502, 1600), ("b", 5, 9)]
    assert {r.id for r in intervals.covered_by_others(df).collect()} == {5}


def test_bad_cycles_stay_bad(spark):
    rows = [(1, c, e) for c, e in ((1, 1.0), (2, 7.5), (3, 0.0), (-1, 0.0), (-2, None))]
    out = windows.bad_cycles(spark.createDataFrame(rows, "tile int, cycle int, errorrate double")).collect()
    assert sorted(r.cycle for r in out) == [-2, 2, 3]


def test_dropoff_and_smoothing(spark):
    rows = [("k", i, v) for i, v in enumerate((0, 8, 1, 0, 0, 16, 0))]
    df = spark.createDataFrame(rows, "key string, pos long, v long")
    got = [r.smooth for r in sorted(windows.dropoff(df, ["key"], "pos", "v").collect(), key=lambda r: r.pos)]
    assert [round(x, 6) for x in got] == [4, 8, 4, 4, 8, 16, 8]
    flat = windows.smoothed(spark.createDataFrame([("k", i, v) for i, v in enumerate((100, 109, 111, 112, 50))], "key string, pos long, v long"), ["key"], "v").first()
    assert [tuple(g) for g in flat.groups] == [(100, 2), (111, 2), (50, 1)]


def test_deletion_shift(spark):
    rows = [("r", p) for p in (10, 11, 12, 40, 41)]
    groups = intervals.deletion_groups(spark.createDataFrame(rows, "key string, pos long"), ["key"])
    assert [(r["first"], r.n, r.new_first) for r in intervals.shifted_deletions(groups, F.lit(0)).collect()] == [(10, 3, 9)]


def test_scores(spark):
    assert column(spark, lambda a, b: scores.overlap_pvalue(a.cast("int"), b.cast("int")), 1, 0) == pytest.approx(1.0)
    assert column(spark, lambda a, b: scores.overlap_pvalue(a.cast("int"), b.cast("int")), 0, 2) == pytest.approx(1 / 16)
    assert column(spark, scores.amplified_overlap_score, 41, 40) == 0.0


def test_names(spark):
    assert [column(spark, names.genotype, s) for s in ("HCV-1c", "HCV-1b", "HCV-6e", "HCV-3a")] == ["1A", "1B", "6E", "3"]
    assert column(spark, names.reported_region, "HCV1A-H77-NS3") == "NS3"


def test_joined_tables_refuse_clashes(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(ValueError, match="more than one"):
        runs.joined_tables([a, a], "k")
    with pytest.raises(PySparkException):
        runs.overridden(a, spark.createDataFrame([(2, "y")], "k int, v string"), "k", "v").collect()


def test_strict_pairs(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string"), spark.createDataFrame([(1, "z")], "i int, s string")
    with pytest.raises(PySparkException):
        pairing.pair_by_index(a, b, "i").collect()
    assert pairing.pair_by_index(a, b, "i", strict=False).count() == 1
    with pytest.raises(PySparkException):
        pairing.join_mates(a, b, "i").collect()


def test_palindromes_count_twice(spark):
    reads = spark.createDataFrame([("ACGT",), ("AAAA",)], "seq string")
    contigs = spark.createDataFrame([("c", "TTACGTAAAA")], "contig string, seq string")
    assert sorted(map(tuple, kmers.placements(reads, contigs, 4).collect())) == [("c", 2, 2), ("c", 6, 1)]


def test_missing_position_fails_a_call(spark):
    positions = spark.createDataFrame([("s", 1, ["A"]), ("s", 2, [])], "seed string, pos long, aminos array<string>")
    rules = spark.createDataFrame([("D", 1, "AC", 9, None), ("D", 2, "G", 1, None), ("E", 1, "A", 9, None)], "drug string, pos long, rule string, score int, flag string")
    out = {r.drug: r.level for r in resist.levels(resist.rule_scores(positions, rules), [(-9, 3, 1), (4, 7, 4), (8, 99, 5)]).collect()}
    assert out == {"D": 0, "E": 5}


def test_fastq_and_fasta_files(spark, tmp_path):
    reads = spark.createDataFrame([("r1", "ACGT", "@@II"), ("r2", "", "")], "name string, seq string, qual string")
    files.write_fastq(reads, f"{tmp_path}/q")
    assert sorted((r.name, r.seq, r.qual) for r in files.read_fastq(spark, f"{tmp_path}/q").collect()) == [("r1", "ACGT", "@@II"), ("r2", "", "")]
    (tmp_path / "x.fasta").write_text(">a b\nAC\nGT\n>c\n\nTT\n")
    assert sorted(map(tuple, files.read_fasta(spark, f"{tmp_path}/x.fasta").collect())) == [("a b", "ACGT"), ("c", "TT")]


def test_every_nth_name_is_numbered_in_ranges(spark):
    names = [None, *(f"r{i * 7919 % 5003:05d}" for i in range(5003))]
    rows = spark.createDataFrame([(x,) for x in names * 2], "name string")
    for n in (1, 10, 6000):
        out = runs.every_nth(rows, "name", n)
        assert sorted((r.name for r in out.collect()), key=str) == sorted(sorted(names, key=lambda x: (x is not None, x or ""))[::n], key=str)
    assert "row_number() windowspecdefinition(name" not in out._jdf.queryExecution().analyzed().toString()
    assert runs.every_nth(rows.limit(0), "name", 10).collect() == []


def test_remap_consensus(spark):
    """Tokens by count then letters; whole-codon insertions join their base; deletions of whole codons go; N where nothing is."""

    def of(rows, inserts=(), seeds=None):
        bases = spark.createDataFrame(rows, "rname string, pos long, base string")
        held = spark.createDataFrame(list(inserts), "rname string, pos long, base string, insert string")
        table = spark.createDataFrame(seeds, "rname string, seed string") if seeds else None
        return {r.rname: r.sequence for r in segments.remap_consensus(segments.remap_tokens(bases, held), table).collect()}

    def read(text, start=1, name="r"):
        return [(name, start + i, c) for i, c in enumerate(text)]

    assert of(read("ACGT") + read("ACCT")) == {"r": "ACCT"}
    assert of(read("AC", 3)) == {"r": "NNAC"}
    assert of(read("AnNC")) == {"r": "ANNC"}
    assert of(read("A---C") + read("A--", 1, "s") + read("T-G", 1, "t") + read("N-", 1, "u")) == {"r": "AC", "s": "A", "t": "T-G"}
    assert of(read("ACGT") * 2, [("r", 2, "C", "GGG")] * 2 + [("r", 3, "G", "AA")]) == {"r": "ACGGGGT"}
    assert of(read("A-N", 2) + read("----", 1, "s"), seeds=[("r", "TTGGCC"), ("s", "AA")]) == {"r": "TAGGCC"}
    assert of(read("A-NC")) == {"r": "AN-C"}


def test_attached_counts(spark):
    report = spark.createDataFrame([("s", "g", p, i) for p, i in enumerate([None, None, 12, None, 14, 15, None], 1)] + [("s", "h", 1, None)], "seed string, region string, pos long, idx long")
    at = spark.createDataFrame([("s", q, 100 + q) for q in range(9, 20)], "seed string, query_pos long, n long")
    own = spark.createDataFrame([("s", "g", 3, 1), ("s", "g", 4, 1)], "seed string, region string, pos long, n long")
    got = {(r.region, r.pos): (r.query_pos, r.clip_count, r.insertion_count) for r in segments.attached_counts(report, at, at, own).collect()}
    want = {1: 11, 2: 12, 3: 13, 4: None, 5: 15, 6: 16, 7: 17}
    assert got == {("g", p): (q, q and 100 + q, q and 100 + q + (p == 3)) for p, q in want.items()} | {("h", 1): (None, None, None)}
    assert [r.query_pos for r in segments.attached_counts(report, at, at, own, step=3).filter("region = 'g'").orderBy("pos").collect()] == [7, 10, 13, None, 15, 16, 19]


def test_matches_that_collide_go(spark):
    hits = [("c", "a", 50, 0, 100, 1), ("c", "a", 40, 91, 191, 2), ("c", "a", 45, 89, 120, 3), ("c", "b", 49, 300, 400, 4), ("c", "a", 40, 190, 200, 5), ("c", "a", 1, 5, 5, 6), ("d", "b", 7, 1, 2, 7)]
    out = segments.separate_matches(spark.createDataFrame(hits, "contig string, ref string, score long, start long, end long, ord long")).collect()
    assert sorted(r.ord for r in out) == [1, 2, 7]


def test_cover_is_removed_one_at_a_time(spark):
    def of(*spans):
        rows = [("r", i, *x) for i, x in enumerate(spans)]
        out = intervals.without_covered(spark.createDataFrame(rows, "ref string, id long, r_st long, r_ei long, reads long"), ["ref"])
        return sorted(r.id for r in out.collect())

    assert of((0, 4, 10), (1, 10, 5), (3, 12, 6), (9, 14, 10)) == [0, 2, 3]
    assert of((0, 4, 10), (1, 10, 6), (3, 12, 5), (9, 14, 10)) == [0, 1, 3]
    assert of((0, 9, 5), (0, 9, 6)) == [1] and of((0, 9, 5), (0, 9, 5)) == [0, 1]
    assert of((0, 9, None), (2, 5, 100), (7, 8, None)) == [0] and of((0, 4, 1), (5, 9, 2), (0, 9, 2)) == [2]
    assert of((0, 4, 3), (5, 9, 2), (0, 9, 1)) == [0, 1] and of((0, 3, 9), (20, 30, 1)) == [0, 1]


def test_match_spectrum(spark):
    def of(*contigs, most=3):
        out = kmers.match_spectrum(spark.createDataFrame([(c,) for c in contigs], "s string"), "s", most).collect()
        return {(r.size, r.kmer, r.matches): r.occurrences for r in out}

    assert of("AA") == {(1, "A", 1): 1}
    assert of("ACAC", most=2) == {(1, "A", 1): 1, (1, "C", 1): 1, (2, "AC", 2): 1}
    assert of("A", "A", "") == {} and of("AA", "AAA", most=1) == {(1, "A", 1): 3}
    assert of("ACATC", most=2)[(2, "AC", 1)] == 2


def test_match_spectrum_of_long_kmers_matches_a_scan(spark):
    rng = random.Random(7)
    contigs = ["".join(rng.choices("ACGTN-RV", k=n)) for n in (3, 25, 60)]
    want = collections.Counter()
    for c in contigs:
        for k in range(1, 13):
            last = {c[i : i + k]: i for i in range(len(c) - k + 1)}
            for kmer, i in last.items():
                for j in range(len(c) - k + 1):
                    if abs(j - i) >= k and (n := sum(a == b for a, b in zip(kmer, c[j : j + k], strict=True))):
                        want[k, kmer, n] += 1
    out = kmers.match_spectrum(spark.createDataFrame([(c,) for c in contigs], "s string"), "s", 12).collect()
    assert {(r["size"], r.kmer, r.matches): r.occurrences for r in out} == dict(want)


def test_significant_changes(spark):
    def of(old, new):
        schema = "pos long, base string, A long, C long, G long, T long, coverage long"
        a, b = (spark.createDataFrame([(1, *x)] if x else [], schema) for x in (old, new))
        return runs.significant_changes(a, b, ["pos"]).count() == 1

    assert not of(("A", 90, 10, 0, 0, 100), ("A", 10, 90, 0, 0, 100))
    assert of(("A", 90, 10, 0, 0, 100), ("C", 10, 90, 0, 0, 100)) and not of(("A", 51, 49, 0, 0, 100), ("C", 49, 51, 0, 0, 100))
    assert of(("A", 51, 49, 0, 0, 100), ("M", 50, 50, 0, 0, 100)) and of(("A", 51, 49, 0, 0, 100), None)
    assert of(("x", 90, 0, 0, 0, 99), ("-", 10, 0, 0, 0, 400)) and not of(("x", 99, 0, 0, 0, 99), ("A", 100, 0, 0, 0, 100)) and not of(("x", 0, 0, 0, 0, 0), ("-", 0, 0, 0, 0, 0))


def test_equal_mapping_quality_is_told_by_alignment_score(spark):
    rows = [("a", 99, 1, "r1", 40, 7), ("a", 147, 2, "r2", 40, 8), ("b", 99, 1, "r1", 9, 1), ("b", 147, 2, "r2", 10, 0), ("c", 99, 1, "r1", 5, 3), ("c", 147, 2, "r2", 5, 3), ("d", 99, 1, "r1", 5, None), ("d", 147, 2, "r2", 5, 0), ("e", 99, 1, "r1", 5, 1), ("e", 147, 2, "r1", 6, 1), ("f", 99, 1, "r1", 5, 1), ("f", 4, 2, "r2", 6, 1)]
    sam = spark.createDataFrame(rows, "qname string, flag int, mate int, rname string, mapq int, score int")
    assert {r.qname: r.rname for r in pairing.resolve_mixed_references(sam).collect()} == {"a": "r2", "b": "r2", "c": "r1", "d": "r2"}


def test_best_partner_matches_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(150):
        start = rng.randrange(0, 400)
        rows.append((i, rng.choice(["a", "b"]), start, start + rng.choice([0, 1, 7, 40, 200]), 1))
    rows += [(900, "c", 5, 5, 1), (901, "c", 6, 6, 1), (902, "d", 0, 1 << 28, 1), (903, "d", 1 << 28, 1 << 28, 1)]
    want = {}
    for i, ref, a, b, _ in rows:
        others = [(c - d, j) for j, r, c, d, _ in rows if j != i and r == ref and a <= d and c <= b]
        if others:
            want[i] = min(others)[1]
    out = intervals.best_partner(spark.createDataFrame(rows, "id long, ref string, r_st long, r_ei long, reads long")).collect()
    assert {r.id: r.partner for r in out} == want
