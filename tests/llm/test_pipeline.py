import random
from collections import Counter

import corpus_pipeline
from readloom.llm import near as blocks, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) + ("." if i % 9 == 8 else "") for i in range(n))


def near(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def rows_of(rng):
    rows, groups = [], {}
    for i in range(150):
        text = prose(rng, rng.randrange(80, 200))
        rows.append((i, text))
        groups[i] = i
        if i % 5 == 0:
            for k in range(rng.randrange(1, 6)):
                doc = 1000 + 10 * i + k
                rows.append((doc, near(rng, text, 1) if k else text))
                groups[doc] = i
    return [(d, t, "en", f"s{d % 3}", len(t)) for d, t in rows], groups


def similar(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def test_one_of_each_group_matches_all_pairs(spark, monkeypatch):
    rng = random.Random(1)
    rows, _ = rows_of(rng)
    rows += [(-5, None, None, None, None), (-4, "", None, None, None), rows[0], (None, "no id here", None, None, None)]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1] or "", rows[j][1] or ""
            if a == b or similar(a, b) >= 0.8 and a and b:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r[0])
    want = sorted(min(g, key=lambda d: (d is not None, d or 0)) or 0 for g in groups.values())
    for members, crowded_over in ((2048, 65_536), (3, 65_536), (2, 4)):
        monkeypatch.setattr(blocks, "MEMBERS", members)
        out = simhash.one_of_each_group(spark.createDataFrame(rows, SCHEMA), crowded_over=crowded_over).collect()
        assert out and list(out[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(r.doc_id or 0 for r in out) == want


def test_copies_behind_many_texts_that_are_less_similar(spark, monkeypatch):
    """Texts at 0.6 to 0.8 of one another, a few of which have a true copy: all of a group must be found."""
    rng = random.Random(9)
    base = prose(rng, 150)
    rows = [(i, near(rng, base, rng.choice((2, 3, 4)))) for i in range(60)]
    rows += [(100 + i, near(rng, rows[7 * i][1], 1)) for i in range(8)]
    least = {d: d for d, _ in rows}
    pairs = [(a, b) for i, (a, x) in enumerate(rows) for b, y in rows[i + 1 :] if similar(x, y) >= 0.8]
    while any(least[a] != least[b] for a, b in pairs):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], SCHEMA)
    for members, crowded_over in ((2048, 65_536), (4, 65_536), (8, 10)):
        monkeypatch.setattr(blocks, "MEMBERS", members)
        assert {r.doc_id for r in simhash.one_of_each_group(docs, crowded_over=crowded_over).collect()} == {d for d in least if least[d] == d}


def test_texts_under_null_and_shared_ids_are_documents_each(spark):
    rng = random.Random(4)
    texts = [prose(rng, 100) for _ in range(40)]
    rows = [(None if i < 20 else 5, t) for i, t in enumerate(texts)]
    rows += [(9, texts[20]), (9, near(rng, texts[21], 1)), (None, near(rng, texts[22], 1)), (3, near(rng, texts[23], 1)), (None, texts[0]), (5, None), (5, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA)
    want = [(None if i < 20 else 5, t) for i, t in enumerate(texts) if i not in (22, 23)] + [rows[42], rows[43]]
    got = [(r.doc_id, r.text) for r in simhash.one_of_each_group(docs).collect()]
    wordless = [g for g in got if not g[1]]
    assert len(wordless) == 1 and wordless[0][0] == 5
    assert sorted(map(str, (g for g in got if g[1]))) == sorted(map(str, want))


def test_a_rejected_text_takes_no_other_of_its_id_along(spark, tmp_path):
    rng = random.Random(5)
    good, junk = ([f(prose(rng, 100)) for _ in range(60)] for f in (str, lambda t: " ".join(w.upper() + "!!$$" for w in t.split())))
    rows = [(i, t) for i, t in enumerate(good[:40] + junk[:40])] + [(None, t) for t in good[40:50] + junk[40:50]] + [(999, t) for t in good[50:] + junk[50:]]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], SCHEMA)
    labels = [(i, int(i < 40)) for i in range(80)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.good_documents(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and {r.text for r in out.collect()} == set(good)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.one_of_each_group(empty).collect() == []


def test_stages_keep_clean_documents(spark, tmp_path):
    rng = random.Random(2)
    rows, groups = rows_of(rng)
    junk = [(5000 + i, " ".join(w.upper() + "!!$$" for w in prose(rng, 60).split()), "en", "s1", 1) for i in range(40)]
    passage = prose(rng, 60) + "."
    shared = [(7000 + i, f"{prose(rng, 50)}.\n{passage}\n{prose(rng, 40)}.", "en", "s0", 1) for i in range(10)]
    spark.createDataFrame(rows + junk + shared, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], 1) for r in rows] + [(r[0], 0) for r in junk[:30]]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    good = {r[0] for r in rows + shared}
    assert set(seen["quality"]) == good
    assert set(seen["near_copies"]) == {groups.get(d, d) for d in good}
    assert set(seen["spans"]) == set(seen["near_copies"])
    middle = passage.split()[30]
    assert sum(middle in r.text.split() for r in seen["spans"].values()) == 1
    taken = Counter(r.doc_id for r in spark.read.parquet(f"{tmp_path}/mixing").collect())
    assert max(taken.values()) <= 3
    pieces = spark.read.parquet(f"{tmp_path}/packing").collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == taken


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_stages_take_messy_rows_and_none(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, ties, clashing names; and an empty table."""
    rng = random.Random(12)
    more = ["same", "doc", "key", "spans", "copies", "row", "node", "piece"]
    texts = [prose(rng, rng.randrange(20, 60)) for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 2}", len(t), *range(8)) for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None, *[None] * 8), (None, texts[0], None, None, None, *[None] * 8), (77, "", "en", "s0", 0, *[None] * 8)]
    rows += [rows[0]] * 3 + [(77, None, None, "s1", None, *[1] * 8), (78, prose(rng, 30_000), "en", "s1", 0, *[2] * 8)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", {c} int" for c in more))
    labels = [(i, i % 5 > 0) for i in range(20)] + [(None, True), (5, None)]
    spark.createDataFrame([(d, None if q is None else int(q)) for d, q in labels], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, str(tmp_path))
            got = [(r.doc_id, r.text) if name != "packing" else (r.doc_id, r.piece) for r in out.collect()]
            assert bool(got) == (given is docs), name
            assert name == "packing" or out.columns == docs.columns
            if name in ("quality", "near_copies", "mixing"):
                assert set(got) <= {(r[0], r[1]) for r in rows}
            if name == "near_copies" and got:
                assert len({t or "" for _, t in got}) == len(got) == 32
