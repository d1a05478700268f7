"""Nearest references: no distance of a pair takes its whole matrix, and two texts of like length meet once, however many tiles there are."""

import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from readloom.operators import distances, edits


def edited(rng, seq, n, letters):
    for _ in range(n):
        i = rng.randrange(len(seq) + 1)
        seq = rng.choice((seq[:i] + rng.choice(letters) + seq[i:], seq[:i] + seq[i + 1 :], seq[:i] + rng.choice(letters) + seq[i + 1 :]))
    return seq


@pytest.mark.parametrize("letters", ["ACGT", "A", "ACGTNé\U0001f600xyz"])
def test_distances_within_a_radius(letters):
    rng = random.Random(1)
    texts = []
    for n in (0, 1, 5, 31, 32, 33, 64, 90, 200, 400):
        base = "".join(rng.choices(letters, k=n))
        texts += [edited(rng, base, k, letters) for k in (0, 3, 9, 20, 40)]
    one, two = np.array(list(combinations(range(len(texts)), 2))).T
    want = edits.distances([texts[i] for i in one], [texts[i] for i in two])
    for radius in (0, 1, 8, 32, 50):
        assert edits.within(edits.Texts(texts), one, two, radius).tolist() == np.minimum(want, radius + 1).tolist()


@pytest.mark.parametrize("radius", [3, 32])
def test_no_pair_is_ruled_out_wrongly(radius):
    rng = random.Random(2)
    bases = ["".join(rng.choices(a, k=n)) for n in (3, 60, 170, 300, 1500, 6000) for a in ("ACGT", "AC", "ACGTN\U0001f600")]
    texts = sorted((edited(rng, b, k, "ACGT") for b in bases for k in (0, 2, 6, 30)), key=len)
    pairs = np.array(list(combinations(range(len(texts)), 2)))
    want = edits.distances([texts[i] for i, _ in pairs], [texts[j] for _, j in pairs])
    want = {(int(i), int(j)): d for (i, j), d in zip(pairs, want.tolist(), strict=True) if d <= radius}
    each, every, known = np.arange(len(texts)), lambda i, near: slice(None), edits.Texts(texts)
    met = lambda one, other: {(int(min(i, j)), int(max(i, j))): int(d) for x in distances._met(one, other, known, every, radius) for i, j, d in zip(*x, strict=True)}
    assert met(each, each) == want
    assert met(each[::2], each[1::2]) == {(i, j): d for (i, j), d in want.items() if i % 2 != j % 2}


def test_long_texts_take_no_matrix(monkeypatch):
    """A text and itself, and a few edits of it, were compared letter by letter."""
    for name in ("_one", "_many", "distances"):
        monkeypatch.setattr(edits, name, None)
    rng = random.Random(3)
    base = "".join(rng.choices("ACGT", k=200_000))
    seqs = [base, base[:70_000] + base[70_003:], base[:5] + "T" + base[5:150_000] + base[150_020:]]
    cell = pd.DataFrame({"asks": True, "offers": True, "text": ["a", "b", "c"], "kind": ["k", "l", "k"], "seq": seqs, "first": [1, 2, 3], "second": [1, 2, 3], "tile": 0, "alone": True})
    out = distances._of_cell(cell, 32)
    own, other = ({(r.text, r.distance, r.reference) for r in out.itertuples() if r.own == x} for x in (True, False))
    assert own == {("a", 0, 1), ("a", 21, 3), ("c", 0, 3), ("c", 21, 1), ("b", 0, 2)}
    assert other == {("a", 0, 1), ("a", 3, 2), ("b", 0, 2), ("b", 3, 1), ("c", 0, 3), ("c", 21, 1)}


def test_nearest_over_many_tiles(spark, monkeypatch):
    """Two tables whose texts are partly the same, lengths from 0 on with gaps, in tiles of a few rows."""
    rng = random.Random(4)
    bases = ["".join(rng.choices("ACGT", k=n)) for n in (0, 20, 24, 60, 100, 101, 140, 400)]
    rows = [(i, rng.choice(["k0", "k1", None]), edited(rng, bases[i % 8], rng.randrange(12), "ACGT")) for i in range(140)]
    samples, refs = rows[:90] + [(200, "k0", None)], [(i + 10**16, k, s) for i, k, s in rows[50:]] + [(7, *rows[7][1:]), (8, "k1", rows[8][2]), (300, "k0", None)]
    for name, value in (("ROWS", 12), ("ROOM", 3000)):
        monkeypatch.setattr(distances, name, value)
    of = lambda some, name: spark.createDataFrame(some, f"{name} long, kind string, seq string")
    found = {r.id: tuple(r)[1:] for r in distances.nearest(of(samples, "id"), of(refs, "reference"), 20, 4, 2).collect()}
    both = [(s, t) for _, _, s in samples for _, _, t in refs if None not in (s, t)]
    far = dict(zip(both, edits.distances([s for s, _ in both], [t for _, t in both]).tolist(), strict=True))
    for i, kind, seq in samples:
        near = sorted((far[seq, t], r, k) for r, k, t in refs if None not in (seq, t) and r != i and far[seq, t] <= 20)
        own = [x for x in near if x[2] == kind]
        assert found.pop(i) == (*(near[0][1::-1] if near else (None, None)), *(own[0][1::-1] if own else (None, None)))
    assert not found


def test_long_texts_among_themselves(spark):
    rng = random.Random(5)
    base = "".join(rng.choices("ACGT", k=300_000))
    rows = [(1, "k", base), (2, "l", base[:9] + base[10:]), (3, "k", base[:200_000] + "ACGTACGT" + base[200_000:]), (4, "k", "ACGT"), (5, "k", None)]
    out = distances.nearest(spark.createDataFrame(rows, "id long, kind string, seq string"), None, 32)
    assert {tuple(r) for r in out.collect()} == {(1, 2, 1, 3, 8), (2, 1, 1, None, None), (3, 1, 8, 1, 8), (4, None, None, None, None), (5, None, None, None, None)}
