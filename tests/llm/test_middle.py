import hashlib
import random
import re

from pyspark.sql import functions as F

from readloom.llm import middle

SCHEMA = "doc_id long, text string"


def plain_form(doc, text, per_cent=100, spm_per_cent=50):
    """The rule by regular expression over code points."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= per_cent:
        return (doc, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm_per_cent:
        return (doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def texts(rng):
    letters = "ab <é€😀\n>PSM\r"
    made = ["".join(rng.choices(letters, k=rng.choice((0, 1, 5, 300, 3000, 20000)))) for _ in range(60)]
    return [*made, None, "", "\n", "\n\n", "no end", "x\ny", "<P", "a<S>b", "é" * 30000 + "\n", "\n" * 9000, "same line\n" * 4000]


def test_matches_the_rule_and_round_trips(spark):
    rng = random.Random(5)
    rows = list(enumerate(texts(rng))) + [(None, "one\ntwo\nthree\n"), (None, "other\nlines\n"), (3, "repeated\nid"), (3, "repeated\nid"), ((1 << 62) + 1, "large\nid\n")]
    formed = middle.fill_in_middle(spark.createDataFrame(rows, SCHEMA))
    back = formed.withColumn("back", middle.restored("output", "form")).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted((tuple(r)[:6] for r in back), key=order) == sorted((plain_form(*r) for r in rows), key=order)
    by_output = {(r.doc_id, r.output): r.back for r in back}
    assert all(by_output[(d, plain_form(d, t)[-1])] == (t or "") for d, t in rows)
    assert {r.form for r in back} == {"plain", "psm", "spm"}


def test_shares_are_arguments(spark):
    rows = [(i, f"line {i}\nand more\nto cut\n") for i in range(400)]
    formed = middle.fill_in_middle(spark.createDataFrame(rows, SCHEMA), per_cent=60, spm_per_cent=25).collect()
    assert sorted(map(tuple, formed)) == sorted(plain_form(*r, 60, 25) for r in rows)


def test_chunks_follow_the_content():
    rng = random.Random(2)
    passage = rng.randbytes(40_000)
    one, other = (middle.chunks(rng.randbytes(n) + passage) for n in (3_001, 9_777))
    assert b"".join(one)[-40_000:] == passage == b"".join(other)[-40_000:]
    assert len({*one} & {*other}) >= 0.9 * len([c for c in one if c in passage])
    assert all(middle.LEAST <= len(c) <= middle.MOST for c in one[:-1])


def test_shared_chunks_are_summed_up_once_and_memory_is_bounded():
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdé \n", k=60_000)).encode()
    memo = middle.Memo()
    middle.lined(passage, memo)
    first = memo.hits
    assert middle.lined(b"ahead of it\n" * 50 + passage, memo).lines == passage.count(b"\n") + 50 + (passage[-1] != 10)
    assert memo.hits - first > 20
    small = middle.Memo(kept=5)
    middle.lined(passage, small)
    assert len(small.new) <= 5 and len(small.old) <= 5


def test_a_sentinel_across_chunks_is_seen():
    for before in (middle.MOST - 1, middle.MOST - 2):  # one letter gives no place, so the chunk ends where it must
        held = b"a" * before + b"<S>" + b"a" * 500
        assert not any(b"<S>" in c for c in middle.chunks(held))
        assert middle.lined(held, middle.Memo()).sentinel
    assert not middle.lined(b"a" * 20_000, middle.Memo()).sentinel


def test_extra_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a\nb\n", "x", 2)], "doc_id long, text string, doc string, n int")
    assert middle.fill_in_middle(docs).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert middle.fill_in_middle(docs).first().n == 2
    assert middle.fill_in_middle(docs.filter(F.lit(False))).count() == 0
