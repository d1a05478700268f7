import random

import numpy as np
from pyspark.sql import functions as F

from readloom.operators import kmers, stretches


def sequences(rng, n):
    """Of few letters, with copies of parts, runs of one letter and others than bases."""
    out = []
    for _ in range(n):
        s = "".join(rng.choices("ACGT", k=rng.randrange(0, 120))) if rng.random() < 0.8 else "A" * rng.randrange(0, 40) + "éN-" * 3
        if out and rng.random() < 0.5:
            s += rng.choice(out)[rng.randrange(30) :][:60]
        out.append(s)
    return out


def test_hashes_tell_places_alike(monkeypatch):
    codes = stretches.letters("ACGTNACGTNAC")
    for k in range(1, 8):
        found = stretches.hashes(codes, k)
        assert len(found) == 13 - k and found[0] == found[5] and len(set(found.tolist())) == 5
    monkeypatch.setattr(stretches, "PIECE", 50)
    text = "".join(random.Random(5).choices("ACGT", k=333))
    for k in (7, 20):
        starts = []
        for _, places, parts in stretches._pieces([text], k):
            _, part, within, found = stretches._cut(parts, k, True)
            starts += [places[p] + w + i for p, w, t in zip(part, within, found, strict=True) for i in range(len(t) - k + 1)]
        assert starts == list(range(len(text) - k + 1))


def test_placements_against_plain_search(spark):
    rng = random.Random(3)
    contigs = sequences(rng, 60)
    turned = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = [c[i : i + 12] for c in contigs for i in range(0, len(c), 17)] + ["ACGTACGTACGT", None]
    reads += [turned(r) for r in reads[:40] if r]
    got = kmers.placements(spark.createDataFrame([(r,) for r in reads], "seq string"), spark.createDataFrame([*enumerate(contigs), (99, None)], "contig int, seq string"), 12).collect()
    want = {}
    for n, c in enumerate(contigs):
        for i in range(len(c) - 11):
            own = c[i : i + 12]
            found = 0 if "N" in own else sum((r == own) + (turned(r) == own) for r in reads if r)
            if found:
                want[n, i] = found
    assert {(r.contig, r.start): r.n for r in got} == want and len(got) == len(want)


def test_classes_against_plain_sets(spark):
    rng = random.Random(4)
    rows = [*enumerate(sequences(rng, 50)), (7, "ACGTACGTACGTACC"), (70, None)]
    got = kmers.sharing(spark.createDataFrame(rows, "id long, seq string"), "id", 9).collect()
    owners = {}
    for n, s in rows:
        for i in range(len(s or "") - 8):
            owners.setdefault(s[i : i + 9], set()).add(n)
    classes = {}
    for o in owners.values():
        if len(o) > 1:
            classes[frozenset(o)] = classes.get(frozenset(o), 0) + 1
    want = [(n, min(o), len(o), c, False) for o, c in classes.items() for n in o] + [(n, None, None, None, True) for n, s in rows if s is not None and len(s) < 9]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_kmers_are_not_shuffled_one_by_one(spark):
    """Rows shuffled are stretches of several k-mers."""
    rng = np.random.default_rng(1)
    seqs = spark.createDataFrame([(i, "".join(rng.choice(list("ACGT"), 3000))) for i in range(5)], "id long, seq string")
    for k in (30, 60):
        cut = stretches.stretches(seqs, "id", k)
        n, total = cut.agg(F.count(F.lit(1)), F.sum(F.length("letters"))).first()
        assert n < 15_000 / 7 and total < 15_000 * 6
    plan = kmers.sharing(seqs, "id", 30)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "generate" not in plan
