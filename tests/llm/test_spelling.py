import random
import re
import zlib
from collections import Counter

import pytest

from readloom.llm import spelling

SCHEMA = "doc_id long, text string"


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_all_pairs(counts, times=5):
    found = {}
    for word, n in counts.items():
        around = sorted(((-m, other) for other, m in counts.items() if near(word, other)))
        form = around[0] if around and -around[0][0] >= times * n else (None, None)
        found[word] = (form[1], n, len(around), -form[0] if form[1] else None)

    def root(word):
        return root(found[word][0]) if found[word][0] else word

    return sorted((w, f or "", root(w), n, k, m or 0) for w, (f, n, k, m) in found.items())


def words_of(rows, letters=6, least=5, slip=199):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= letters and n >= least}


def plain(found):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in found)


def corpus(rng):
    stems = ["".join(rng.choices("abÉé", k=rng.choice((5, 6, 7, 9, 14)))) for _ in range(30)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "a" * 70, "a" * 71]
    made = []
    for stem in stems:
        for _ in range(6):
            i = rng.randrange(len(stem))
            word = rng.choice((stem, stem[:i] + rng.choice("abc") + stem[i:], stem[:i] + stem[i + 1 :], stem[:i] + rng.choice("abÿ") + stem[i + 1 :]))
            made += [word] * rng.choice((4, 5, 6, 30, 200))
    rng.shuffle(made)
    return made


def test_matches_all_pairs(spark):
    rng = random.Random(8)
    made = corpus(rng)
    rows = [(i, rng.choice((" ", ", ", "-", "\n", "1")).join(w.capitalize() if rng.random() < 0.2 else w for w in made[i * 40 : i * 40 + 40])) for i in range(len(made) // 40 + 1)]
    rows += [(None, "aaaaaa aaaaaa Aaaaaa ÀÀÀÀÀÀ àààààà ×÷×÷×÷ " * 3), (None, None), (7, ""), (8, "1 2 3"), rows[3], rows[3]]
    found = spelling.variants(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = by_all_pairs(words_of(rows))
    assert plain(found) == expected
    assert any(f for _, f, *_ in expected) and any(r not in (w, f) for w, f, r, *_ in expected)


@pytest.mark.parametrize("block", [1, 40, 400])
def test_blocks_keyed_anew_lose_and_repeat_no_pair(spark, block):
    rng = random.Random(9)
    counts = {w: n + 5 for n, w in enumerate(sorted({"".join(rng.choices("ab", k=rng.choice((3, 4, 5, 6, 9)))) for _ in range(150)} | {"abababababab", "ababababababa", "bababababab"}))}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(words, 3, block).collect()}
    around = {w: sorted((-m, other, m) for other, m in counts.items() if near(w, other)) for w in counts}
    assert found == {w: (len(near_), *near_[0][1:]) for w, near_ in around.items() if near_}


def test_a_long_chain_ends_at_its_root(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(23)] + [("x", "w20")], "word string, form string")
    assert {r.root for r in spelling.roots(links).collect()} == {"w23"}


def test_very_long_words_and_many_in_a_block(spark):
    long = "ab" * 30_000
    rows = [(1, " ".join([long] * 30 + [long[:500] + "c" + long[500:]] * 5))] + [(2, " ".join(f"common{a}{b}" for a in "abcdefghij" for b in "abcdefghij" for _ in range(6)))]
    found = {r.word: r for r in spelling.variants(spark.createDataFrame(rows, SCHEMA), slip=None).collect()}
    assert found[long[:500] + "c" + long[500:]].form == long and found[long].n_near == 1
    assert found["commonaa"].n_near == 18 and found["commonaa"].form is None and len(found) == 102


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "spelling " * 30 + "speling " * 5, "x", 3)], "doc_id long, text string, word string, n int")
    assert plain(spelling.variants(docs, slip=None).collect()) == [("speling", "spelling", "spelling", 5, 1, 30), ("spelling", "", "spelling", 30, 1, 0)]
    assert spelling.variants(docs.filter("n > 3")).count() == 0
