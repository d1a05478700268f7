import random
import tracemalloc

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from readloom.llm import near, simhash
from readloom.llm.components import components


def brute(rows):
    """Fingerprints by hand, components by comparing all pairs."""
    prints = []
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.append((doc, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    parent = {d: d for d, _ in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, p) in enumerate(prints):
        for b, q in prints[:i]:
            if (p ^ q).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((d, f"{p:016x}", root(d)) for d, p in prints)


def run(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, simhash.near_duplicates(docs, **more).collect()))


def test_matches_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choices(words, k=rng.choice((2, 8, 60)))) for _ in range(40)]
    rows = [(7 * i, rng.choice(base)) for i in range(120)] + [(3001 + i, base[i].replace("w1 ", "w2 ", 1)) for i in range(40)]
    rows += [(5001, None), (5002, ""), (5003, " \t\n"), (5004, "One"), (5005, "one"), (5006, "É a\x0bB c")]
    assert run(spark, rows) == brute(rows)


def test_null_ids_and_extra_columns(spark):
    rows = [(None, "a b c d", 1, "x"), (4, "a b c d", 2, "y"), (None, "quite other words here now", 3, "z"), (4, "a b c d", 2, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, least int, component_id string")
    out = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in out) == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]


def test_documents_without_id_link_others(spark, monkeypatch):
    """A chain of fingerprints two bits apart, whose links lead through documents without doc_id."""
    prints = {"a": 0, "b": 3, "c": 15, "d": 63, "e": 31 << 40}
    docs = spark.createDataFrame([(1, "a"), (None, "b"), (9, "c"), (None, "d"), (None, "e")], "doc_id long, text string")
    monkeypatch.setattr(simhash, "fingerprint", lambda text, width: F.coalesce(*(F.when(F.col(text) == k, F.lit(v).cast("long")) for k, v in prints.items())))
    got = {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == {(1, 0): 1, (None, 3): 1, (9, 15): 1, (None, 63): 1, (None, 31 << 40): None}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_every_near_pair_shares_a_block_and_links(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(3)]
    prints = {s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for s in seeds for _ in range(300)} | set(seeds)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(signed)], "fp long, node long")
    for limit in (512, 20):  # with and without blocks keyed anew
        links = simhash.links_in_blocks(simhash.pigeonhole_blocks(df, 2, limit), 2)
        got = {r.node: r.component for r in components(links).collect()}
        assert len({got[i] for i in got}) == 3 and len(got) == len(signed) - 3


def test_nearest_is_the_closest_earlier_row():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 2, (150, 64)).astype(np.uint8)
    prints[:, 12:] = prints[0, 12:]
    values = np.packbits(prints, axis=1, bitorder="little").view(np.int64).ravel()
    pairs = {(a, b): d for later, earlier, dist in simhash.near_lanes(values, np.array([70, 80]), 5) for a, b, d in zip(later, earlier, dist)}
    want = {}
    for lo, hi in ((0, 70), (70, 150)):
        for a in range(lo, hi):
            for b in range(lo, a):
                d = (int(values[a]) ^ int(values[b])).bit_count() if values[a] >= 0 and values[b] >= 0 else int((prints[a] != prints[b]).sum())
                if d <= 5:
                    want[a, b] = d
    assert pairs == want


RULE = near.Rule(80, simhash.ALIKE * simhash.SKETCH, simhash.wide_pairs)


def exact_links(cells):
    return pd.concat(near._exact_links(cells, RULE), ignore_index=True)


def dense_cell(n, seed=5):
    """A block of texts that are alike, but not similar enough: sets of 60 of the same 100 shingles."""
    rng = np.random.default_rng(seed)
    sets = [np.sort(rng.permutation(100)[:60]).astype(np.uint64) for _ in range(n)]
    flips = rng.integers(0, 64, (n, 4)).astype(np.uint64)
    fps = np.bitwise_xor.reduce(np.uint64(1) << flips, axis=1).view(np.int64)
    columns = {"cell": 1, "node": np.arange(n), "component": np.arange(n), "fp": fps, "shingles": 60, "sketch": [bytes(simhash.SKETCH)] * n, "shingle_set": [x.tobytes() for x in sets]}
    return pd.DataFrame(columns), sets


def test_a_dense_block_takes_bounded_memory_and_gives_few_rows():
    cells, _ = dense_cell(6000)
    tracemalloc.start()
    most = max(len(later) for later, _, _ in simhash.near_lanes(cells["fp"].to_numpy(), np.array([6000]), simhash.WIDE_RADIUS))
    open_rows, links = (pd.concat(f(cells, RULE)) for f in (near._open_rows, near._nearest))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most <= simhash.HITS + 64 and len(open_rows) == 6000 and len(links) == 5999
    assert peak < 150 << 20


def test_links_of_a_block_are_those_of_all_pairs():
    cells, sets = dense_cell(300)
    for i in range(0, 300, 7):  # a copy with two shingles fewer
        cells.at[i + 1, "shingle_set"] = sets[i][2:].tobytes()
    cells["shingles"] = [len(x) // 8 for x in cells["shingle_set"]]
    sets = [set(np.frombuffer(x, np.uint64).tolist()) for x in cells["shingle_set"]]
    want = {(a, b) for a in range(300) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    links = exact_links(cells)
    got = set(zip(links["src"], links["dst"], strict=True))
    assert got <= want and len(got) < 300

    def groups(pairs):
        label = np.arange(300)
        for _ in range(300):
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label.tolist()

    assert groups(got) == groups(want)


def test_cells_apart_give_the_same_links(monkeypatch):
    cells, sets = dense_cell(240)
    for i in range(0, 240, 5):
        cells.at[i + 1, "shingle_set"] = sets[i][1:].tobytes()
    cells["shingles"] = [len(x) // 8 for x in cells["shingle_set"]]
    cells["cell"] = np.arange(240) // 20
    links = [exact_links(cells)]
    for most in (1, 3000):
        monkeypatch.setattr(near, "SHINGLES", most)
        links.append(exact_links(cells))
    assert len(links[0]) >= 48 and all(sorted(map(tuple, x.to_numpy())) == sorted(map(tuple, links[0].to_numpy())) for x in links)
