import random

import pytest

from readloom.operators import distances, kmers


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def edited(rng, seq, n):
    for _ in range(n):
        i = rng.randrange(len(seq) + 1)
        seq = rng.choice((seq[:i] + rng.choice("ACGT") + seq[i:], seq[:i] + seq[i + 1 :], seq[:i] + rng.choice("ACGT") + seq[i + 1 :]))
    return seq


def test_classes_hold_exactly_the_pairs_that_share_a_kmer(spark):
    """Links through a third sequence alone, repeats, Ns, and sequences of fewer letters."""
    rng = random.Random(1)
    parts = ["".join(rng.choices("ACGTN", k=9)) for _ in range(12)]
    seqs = {i: "".join(rng.choices(parts, k=rng.randrange(1, 5))) + "".join(rng.choices("ACGT", k=4)) for i in range(60)}
    seqs |= {60: "ACGTACGTAA", 61: "TTGCATTGCA", 62: "ACGTACGGTTGCATTG", 63: "ACG", 64: "", 65: None}
    rows = kmers.sharing(spark.createDataFrame(list(seqs.items()), "id long, seq string"), "id", 6).collect()
    own = {i: {s[j : j + 6] for j in range(len(s) - 5)} for i, s in seqs.items() if s is not None}
    want = {(a, b) for a in own for b in own if a < b and own[a] & own[b]}
    classes = {}
    for r in rows:
        if not r.always:
            classes.setdefault((r.first, r.members, r.kmers), set()).add(r.id)
    assert {(60, 62), (61, 62)} <= want and (60, 61) not in want
    assert {r.id for r in rows if r.always} == {63, 64}
    assert all(min(m) == first for (first, _, _), m in classes.items())
    by_owner = {}
    for k in {k for s in own.values() for k in s}:
        held = frozenset(i for i in own if k in own[i])
        if len(held) > 1:
            by_owner[held] = by_owner.get(held, 0) + 1
    assert sorted((r.id, r.first, r.members, r.kmers) for r in rows if not r.always) == sorted((i, min(h), len(h), n) for h, n in by_owner.items() for i in h)
    assert {(a, b) for h in by_owner for a in h for b in h if a < b} == want


@pytest.mark.parametrize("most, first", [(12, 2), (5, 5)])
def test_nearest_reference_matches_all_pairs_with_few_candidates(spark, most, first):
    rng = random.Random(2)
    bases = ["".join(rng.choices("ACGT", k=rng.choice((30, 90, 200)))) for _ in range(8)]
    refs = [(f"r{i:02}", f"k{i % 3}", edited(rng, bases[i % 8], rng.randrange(7))) for i in range(40)] + [("r98", "k0", "ACG"), ("r99", None, "ACGTT")]
    samples = [(f"s{i:02}", f"k{rng.randrange(4)}", edited(rng, rng.choice(bases), rng.randrange(9))) for i in range(40)] + [("s95", None, "ACGTA"), ("s96", "k0", ""), ("s97", "k1", None), ("r00", *refs[0][1:]), ("s99", "k9", "GATTACA" * 30)]
    of = lambda rows, name: spark.createDataFrame(rows, f"{name} string, kind string, seq string")
    found = {r.id: tuple(r)[1:] for r in distances.nearest(of(samples, "id"), of(refs, "reference"), most, first, 2).collect()}
    want = {}
    for name, kind, seq in samples:
        all_of = sorted((edits(seq, s), r, k) for r, k, s in refs if seq is not None and r != name)
        near = [(d, r, k) for d, r, k in all_of if d <= most]
        own = [x for x in near if x[2] == kind]
        want[name] = (*((near[0][1], near[0][0]) if near else (None, None)), *((own[0][1], own[0][0]) if own else (None, None)))
    assert found == want
    pairs = distances.candidates(of(samples, "id").drop("kind"), of(refs, "reference").drop("kind"), most).count()
    true = sum(edits(s, t) <= most for _, _, s in samples if s is not None for _, _, t in refs)
    assert true <= pairs < len(samples) * len(refs) / 3


def test_no_references(spark):
    none = spark.createDataFrame([], "reference string, kind string, seq string")
    samples = spark.createDataFrame([("a", "k", "ACGT")], "id string, kind string, seq string")
    assert [tuple(r) for r in distances.nearest(samples, none, 5).collect()] == [("a", None, None, None, None)]
    assert distances.nearest(samples.filter("id = 'b'"), none, 5).count() == 0


def drifted(spark, consensus, seeds, reads):
    rows = [("s", n, c, reads[n]) for n, c in consensus.items()]
    out = distances.drop_drifted(spark.createDataFrame(rows, "sample string, name string, seq string, reads long"), spark.createDataFrame([("s", n, x) for n, x in seeds.items()], "sample string, name string, seq string"))
    return {r.name: tuple(r)[2:] for r in out.collect()}


def test_drifted_references_go_one_at_a_time(spark):
    """Two seeds that are each nearer to the other's consensus: the one of fewer reads goes, and the other stays."""
    end = "ACGTTGCAACGGTTAACCGGTATCGA"
    both = drifted(spark, {"test": "AAGCCGTA" + end, "other": "ATGAAGTA" + end, "unrelated": "GGGTTTGGG" + end}, {"test": "ATGAAGTA" + end, "other": "AAGCCGAA" + end, "unrelated": "GGGTTTGGG" + end}, {"test": 2, "other": 1, "unrelated": 1})
    assert both == {"test": (3, 1, "other", True), "other": (4, 0, "test", False), "unrelated": (0, None, None, True)}
    empty = drifted(spark, {"a": "", "b": None, "c": "ACGT"}, {"a": "AA", "b": "CC", "c": "ACGT"}, {"a": 3, "b": 9, "c": 1})
    assert {n: r[3] for n, r in empty.items()} == {"a": False, "b": False, "c": True}
    alone = drifted(spark, {"a": "ACGTACGT"}, {"a": "TTTT"}, {"a": 1})
    assert alone["a"][3]
    tie = drifted(spark, {"a": "AAAA", "b": "CCCC"}, {"a": "CCCC", "b": "AAAA"}, {"a": 5, "b": 5})
    assert {n: r[3] for n, r in tie.items()} == {"a": False, "b": True}
    long = drifted(spark, {"a": "A" * 10_001, "b": "C" * 9}, {"a": "C" * 9, "b": "A" * 10_001}, {"a": 1, "b": 2})
    assert {n: r[3] for n, r in long.items()} == {"a": True, "b": False}
