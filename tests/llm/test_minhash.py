import random

import numpy as np
import pytest

from readloom.llm import minhash, near

SCHEMA = "doc_id long, text string"


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def by_all_pairs(rows, per_cent=85):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= per_cent * len(a | b) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    found = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for (d, _), x in zip(rows, label, strict=True) if x == label[i] and d is not None]
        component = doc if not sets[i] else min(ids, default=None)
        found.append((doc, len(sets[i]), component, doc == component))
    return sorted(found, key=str)


def run(spark, rows, **more):
    return sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), **more).collect()), key=str)


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(rng):
    """Families of texts at 0.7 to 1, chains whose ends are unlike, short and empty ones."""
    rows = []
    for _ in range(12):
        base = " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice((6, 40, 200, 900))))
        for _ in range(8):
            rows.append(edited(rng, base, rng.choice((0, 0, 1, len(base.split()) // 60, len(base.split()) // 30))))
        chain = base
        for _ in range(6):
            chain = edited(rng, chain, max(1, len(base.split()) // 80))
            rows.append(chain)
    rows += [None, None, "", " \t\n", "One", "one", "two words", "Two  Words", "É é", "é é", "a b c d", "a b c d e", "A B\x0bC D E"]
    return rows


def test_matches_all_pairs(spark):
    rng = random.Random(11)
    rows = list(enumerate(corpus(rng), 10))
    rows += [(None, rows[3][1]), (None, "alone without id here and now"), (None, None), (3, rows[20][1]), (5, "repeated row of some words"), (5, "repeated row of some words"), (5, "quite other words under one id here")]
    assert run(spark, rows) == by_all_pairs(rows)


@pytest.mark.parametrize("members, crowded_over", [(3, 1 << 16), (2048, 2), (3, 2)])
def test_large_blocks_split_and_crowded_ones_parted_lose_no_link(spark, monkeypatch, members, crowded_over):
    """Blocks are few and large: one band of one place, all texts with the same shingles at the front."""
    monkeypatch.setattr(near, "MEMBERS", members)
    rng = random.Random(12)
    rows = [(i, t) for i, t in enumerate(corpus(rng)[:90])]
    signed = {d: minhash.shingle_set(t, 5) for d, t in rows}
    signs = spark.createDataFrame([(d, len(h), minhash.sketch(h).astype(np.uint8).tobytes()) for d, h in signed.items()], "node long, shingles long, sketch binary")
    sets = spark.createDataFrame([(d, h.tobytes()) for d, h in signed.items()], "node long, shingle_set binary")
    keyed = spark.createDataFrame([(d, len(h), k) for d, h in signed.items() for k in (1, 2)], "node long, shingles long, key long")
    labels = near.labels(near.sharing_keys(keyed), signs, sets, near.Rule(85, 0), crowded_over)
    found = {r.node: r.component for r in labels.collect()}
    assert sorted(found.get(d, d) for d, _ in rows) == sorted(c for _, _, c, _ in by_all_pairs(rows))


def test_sketch_is_that_of_the_rule():
    """Round by round, as it is written down; every place is filled however few the shingles."""
    full = (1 << 64) - 1

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ x >> 27) * 0x94D049BB133111EB & full
        return x ^ x >> 31

    rng = random.Random(13)
    for n in (1, 2, 7, 125, 3000):
        t, own = minhash.COORDINATES, sorted(rng.getrandbits(64) for _ in range(n))
        least = [None] * t
        for turn in range(2 * t):
            for x in own:
                h = mixed(x ^ mixed((turn + 1) * 0x9E3779B97F4A7C15 & full))
                place = (h & 0xFFFFFFFF) * t >> 32 if turn < t else turn - t
                value = turn << 48 | h >> 16
                least[place] = value if least[place] is None else min(least[place], value)
            if None not in least:
                break
        assert minhash.sketch(np.array(own, np.uint64)).tolist() == least


def test_equal_runs_of_words_have_equal_hashes():
    rng = random.Random(15)
    for n in (0, 1, 4, 5, 6, 60):
        text = " ".join(rng.choice(("a", "b", "É", "Zz")) for _ in range(n))
        assert len(minhash.shingle_set(text, 5)) == len(shingles(text))
        assert {*minhash.shingle_set(text.replace(" ", " \t") + "\n", 5).tolist()} == {*minhash.shingle_set(text.upper().replace("É", "É"), 5).tolist()}


def test_sketches_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(14)
    for n in (20, 300, 5000):
        shares = []
        for _ in range(60):
            h = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            common = int(n * 0.85 / (1 + 0.15 / 2)) // 1
            one, other = h[: (n + common) // 2], np.concatenate([h[:common], h[(n + common) // 2 :]])
            truth = common / n
            shares.append((minhash.sketch(one) == minhash.sketch(other)).mean() - truth)
        assert abs(np.mean(shares)) < 0.02 and np.std(shares) < 0.06


def test_extra_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x", 3), (2, "a b c d e f", "y", 4)], "doc_id long, text string, same string, node int")
    assert sorted(map(tuple, minhash.near_duplicates(docs).collect())) == [(1, 2, 1, True), (2, 2, 1, False)]
    assert minhash.near_duplicates(docs.filter("node > 4")).count() == 0
