import random
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from readloom.llm import spans
from readloom.llm.common import filled_id


def text_of(rng, n):
    return " ".join(" ".join(rng.choices(WORDS, k=rng.randrange(1, 30))) + rng.choice([".", "!", "?!", ".\n", "\n", " |"]) for _ in range(n))


WORDS = [f"w{i}é" for i in range(3000)]


def own_sentences(text):
    """The rule by scanning: pieces up to closing marks or a line's end with the white space after; long ones at least hashes."""
    out, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] not in "\n.!?":
            end += 1
        if end < len(text) and text[end] == "\n":
            end += 1
        else:
            while end < len(text) and text[end] in ".!?":
                end += 1
        while end < len(text) and text[end].isspace():
            end += 1
        words, start = [], at
        for i in range(at, end):
            if not text[i].isspace() and (i + 1 == end or text[i + 1].isspace()):
                stop = i + 1
                while stop < end and text[stop].isspace():
                    stop += 1
                words.append(text[start:stop])
                start = stop
        if not words:
            out.append(text[at:end])
        elif len(words) <= 17:
            out.append("".join(words))
        else:
            plain = [w.strip().lower() for w in words]
            rank = [xxhash.xxh32_intdigest(f"{a} {b}") for a, b in zip(plain, plain[1:])]
            least = {min(range(i, i + 9), key=lambda k: (rank[k], k)) + 1 for i in range(len(rank) - 8)}
            ends = [0, *sorted(least), len(words)]
            out += ["".join(words[a:b]) for a, b in zip(ends, ends[1:])]
        at = end
    return out


def test_sentences_are_those_of_a_plain_scan():
    rng = random.Random(11)
    for _ in range(300):
        text = text_of(rng, rng.randrange(0, 8)).strip()
        assert spans.sentences(text) == own_sentences(text)


def brute(rows):
    seen, gone = {}, {}
    for doc, text in sorted(rows):
        for first, last, run in spans.runs_of(text or ""):
            if seen.setdefault(run, (doc, first)) != (doc, first):
                gone.setdefault(doc, set()).update(range(first, last + 1))
    return sorted((d, t if d not in gone else "".join(s for k, s in enumerate(spans.sentences(t)) if k not in gone[d]), len(gone.get(d, ()))) for d, t in rows)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, _spans string, removed_sentences int")
    out = spans.dedup_spans(docs)
    assert out.columns == ["doc_id", "text", "_spans", "removed_sentences"]
    return sorted((r.doc_id, r.text, r.removed_sentences) for r in out.collect())


def test_sentences_make_up_the_text():
    rng = random.Random(1)
    for _ in range(200):
        text = text_of(rng, rng.randrange(0, 12)) + rng.choice(["", "\n\n", "  ", "end"])
        assert "".join(spans.sentences(text)) == text
    assert spans.sentences("") == [] and spans.runs_of(" \n ") == []


def test_repeated_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(2)
    passages = [" ".join(f"p{i}x{rng.randrange(10**6)}" for _ in range(60)) + rng.choice([".", ""]) for i in range(3)]
    clean = {i: text_of(rng, 9) for i in range(40)}
    rows = [*clean.items(), *((100 + i, f"{text_of(rng, 3)}\n{passages[i % 3]}\n{text_of(rng, 2)}") for i in range(30))]
    rows += [(200, None), (201, ""), (202, clean[3]), (203, "w " * 20000)]
    out = run(spark, rows)
    assert out == brute(rows)
    left = {d: t for d, t, _ in out}
    assert all(left[d] == t for d, t in clean.items()) and left[202] == ""
    for i, p in enumerate(passages):
        assert [d for d in left if left[d] and p.split()[40] in left[d]] == [100 + i]


def test_null_ids_come_first(spark):
    text = "one two three four five six seven eight nine ten. a b c d e f g h i j k."
    docs = spark.createDataFrame([(3, text), (None, text), ((1 << 60) + 1, text)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in spans.dedup_spans(docs).collect()} == {None: text, 3: "", (1 << 60) + 1: ""}


def test_repeats_among_many_batches(spark):
    """A run in most texts and rows repeated, over batches of two rows: all but the first place of each hash, once."""
    rng = random.Random(4)
    common = " ".join(f"c{i}" for i in range(20)) + ". " + " ".join(f"d{i}" for i in range(12)) + "."
    rows = [(rng.randrange(40), f"{text_of(rng, rng.randrange(3))} {common} {text_of(rng, 2)}" if rng.random() < 0.7 else text_of(rng, 4)) for _ in range(80)]
    rows += rows[:30] + [(None, common)] * 5
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        keyed = docs.select(filled_id().alias("doc_id"), "text", F.xxhash64("text").alias("key"))
        got = Counter((r.doc_id, r.key, r.first, r.last) for r in spans.repeats(spans.hashed_runs(keyed)).distinct().collect())
        known = keyed.distinct().collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    places = {}
    for r in known:
        for first, last, run_ in spans.runs_of(r.text):
            places.setdefault(run_, []).append((r.doc_id, r.key, first, last))
    want = {p for own in places.values() for p in own if p[:3] != min(own)[:3]}
    assert len(want) > 100 and set(got) == want


def test_repeated_rows_and_empty_table(spark):
    text = "one two three four five six seven eight nine ten. " + "a b c d e f g h i j k."
    assert run(spark, [(1, text), (1, text)]) == [(1, text, 0)] * 2
    assert run(spark, []) == []


def test_no_window_of_51_words_stays_twice(spark):
    """Passages at shifted offsets of unpunctuated lines, and near copies, against plain windows of 51 words."""
    rng = random.Random(3)

    def words(n, stops):
        return [f"q{rng.randrange(10**6)}" + rng.choice([".", "?\n"]) * (rng.random() < stops) for _ in range(n)]

    rows = []
    for n, stops in enumerate((0, 0, 0.03, 0.1, 0.3)):
        passage = words(51, stops)
        rows += [(100 * n + k, " ".join(words(k, 0) + passage + words(k * 7 % 30, 0))) for k in range(30)]
    whole = words(800, 0.02)
    for k in range(10):
        at = rng.sample(range(800), 8)
        near = [[w] if i not in at else rng.choice(([], [w, "new"], ["new"])) for i, w in enumerate(whole)]
        rows.append((900 + k, " ".join(w for own in near for w in own)))

    def windows(text):
        w = text.lower().split()
        return {tuple(w[i : i + 51]) for i in range(len(w) - 50)}

    seen, before = set(), set()
    for _, text in rows:
        own = windows(text)
        before |= own & seen
        seen |= own
    assert len(before) > 100
    seen = set()
    for _, text, _ in run(spark, rows):
        own = windows(text)
        assert not own & seen
        seen |= own
