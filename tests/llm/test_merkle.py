import hashlib
import random
import re

from pyspark.sql import functions as F

from readloom.llm import merkle


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()[:16]


def levels(text):
    """Nested lists: sections of paragraphs, each a hash with its sentences' hashes."""
    sections = [[]]
    paragraphs = [[md5(s) for s in re.sub(r"([.!?|]\s?)(?=[^\s.!?|])", "\\1\0", p).split("\0")] for p in text.split("\n")]
    for i, own in enumerate(paragraphs):
        node = (md5(",".join(own)), own)
        sections[-1].append(node)
        if node[0][-1] in "0123" and i + 1 < len(paragraphs):
            sections.append([])
    return [(md5(";".join(f"{h}:{','.join(own)}" for h, own in s)), s) for s in sections]


def full(s):
    return hashlib.sha256(s.encode()).hexdigest()


def root(text):
    lines, sections = iter(text.split("\n")), []
    for _, paragraphs in levels(text):
        sections.append(full(";".join(full(next(lines)) for _ in paragraphs)))
    return full(",".join(sections))


def near(x, y):
    """By descent with sets of hashes."""
    if x == y:
        return 1.0
    a, b = levels(x), levels(y)
    count = sum(len({s for _, ps in side for _, own in ps for s in own}) for side in (a, b))
    closed = {h for h, _ in a} & {h for h, _ in b}
    a, b = ([p for h, ps in side if h not in closed for p in ps] for side in (a, b))
    closed = {h for h, _ in a} & {h for h, _ in b}
    a, b = ({s for h, own in side if h not in closed for s in own} for side in (a, b))
    return 1 - len(a ^ b) / count


def text_of(rng):
    return "".join(rng.choice(["one two. ", "é𝄞 x!\n", "\n", "word ", f"w{rng.randrange(10**6)}.\n"]) for _ in range(rng.randrange(0, 60)))


def test_matches_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    ids = rng.sample(range(-500, 10**12), 300)
    rows = [(d, text_of(rng), "x", "y") for d in ids] + [(10**13, None, None, None), (10**13 + 1, "", None, None), (10**14, "long. " * 20000, None, None), (None, "null id\nx", None, None)]
    rows.append((10**13 + 2, rows[0][1], None, None))
    order = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for size in (500, 20):  # one stretch, and many
        monkeypatch.setattr(merkle, "ROWS_A_STRETCH", size)
        out = {r.doc_id: r for r in merkle.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string, next_text string, stretch string")).collect()}
        assert len(out) == len(rows)
        for (doc, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
            r, half = out[doc], len(text) // 2
            edited = text[: len(text) - half] + following[:half]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert (r.fingerprint, r.edited_fingerprint) == (root(text), root(edited))
            assert abs(r.near_edited - near(text, edited)) < 1e-9 and abs(r.near_next - near(text, following)) < 1e-9
            a, b = text.split("\n"), edited.split("\n")
            first = next((i for i in range(max(len(a), len(b))) if a[i : i + 1] != b[i : i + 1]), None)
            assert r.first_edit == first


def test_repeated_ids_one_row_and_no_rows(spark):
    schema = "doc_id long, text string"
    out = merkle.fingerprint_documents(spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c")], schema)).collect()
    assert sorted(r.doc_id for r in out) == [1, 1, 2]
    alone = merkle.fingerprint_documents(spark.createDataFrame([(1, "abcd")], schema)).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1
    assert merkle.fingerprint_documents(spark.createDataFrame([], schema)).collect() == []


def test_an_edit_changes_one_branch(spark):
    lines = [f"line {i} of many." for i in range(60)]
    other = [*lines[:30], "changed", *lines[31:]]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(other))], "a string, b string")
    a, b = merkle.tree(F.col("a")), merkle.tree(F.col("b"))
    r = df.select(F.size(F.array_except(a["sections"], b["sections"])).alias("gone"), merkle.first_difference(a, b).alias("at"), merkle.likeness(a, b).alias("near")).first()
    assert r.gone in (1, 2) and r["at"] == 30 and r.near > 0.95


def test_roots_differ_though_all_short_nodes_are_equal(spark, monkeypatch):
    """As if every 64-bit hash had met its like: the root doesn't stand on them."""
    monkeypatch.setattr(merkle, "_node", lambda content: F.lit("f" * merkle.HASH))
    texts = ["one text.\nof two lines", "other text.\nof two lines", "one text.\nof two lines\n", "one text.", ""]
    rows = spark.createDataFrame([(t,) for t in [*texts, texts[0]]], "x string").select("x", merkle.tree(F.col("x")).alias("t")).collect()
    assert len({r.t.root for r in rows}) == len(texts) and rows[0].t.root == rows[-1].t.root
    assert rows[0].t.sections == rows[1].t.sections


def test_shared_sections_stay_closed(spark):
    """Trees with equal hashes over broken branches count as equal there: only differing sections are read."""
    lines = [f"line {i} of many." for i in range(60)]
    other = [*lines[:30], "changed", *lines[31:]]
    trees = spark.createDataFrame([("\n".join(lines), "\n".join(other))], "x string, y string").select(merkle.tree(F.col("x")).alias("a"), merkle.tree(F.col("y")).alias("b"))
    shared = F.array_intersect(F.col("a.sections"), F.col("b.sections"))
    cut = lambda t: F.col(t).withField("sections", F.transform(F.col(f"{t}.sections"), lambda s: F.when(F.array_contains(shared, s), F.substring(s, 1, merkle.HASH + 1)).otherwise(s)))
    r = trees.select(merkle.likeness(F.col("a"), F.col("b")).alias("whole"), merkle.likeness(cut("a"), cut("b")).alias("cut")).first()
    assert r.whole == r.cut == 1 - 2 / 120


def test_many_rows_without_id(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_A_STRETCH", 5)
    rows = [(None, f"text {i}\nmore {i * 7}") for i in range(40)] + [(i, f"own {i}") for i in range(3)]
    out = merkle.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 43 and sum(r.doc_id is None for r in out) == 40 and {r.fingerprint for r in out} == {root(t) for _, t in rows}
