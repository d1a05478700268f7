import random
import re
import time

from readloom.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hits = [(i, label) for phrase, label in licences.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, x, b, i)
    return row[-1]


def _next(row, x, b, i):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_base_matches_brute_force(spark):
    rng = random.Random(1)
    parts = ["CC BY", "cc", "by", "General Public License", "general-public", "license", "all rights, reserved", "ALL", "Éa", "x9", "\n", "\x7f", "#", "ſ", "K"]
    rows = [(i, " ".join(rng.choices(parts, k=rng.randrange(0, 25))), "z") for i in range(300)]
    rows += [(900, None, None), (901, "", None), (902, "cc by " * 4000, None), rows[0], (None, "cc by", None)]
    out = licences.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out), key=str)
    assert got == sorted(((d, *base(t)) for d, t, _ in rows), key=str)
    for r in out:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(",")))) and (r.score == 1) >= bool(r.n_base)


def test_notices_with_errors_are_found():
    rng = random.Random(2)
    for label, notice in licences.NOTICES:
        k = licences.errors_for(notice)
        for edits in range(k + 1):
            text = list(notice)
            for at in rng.sample(range(len(text)), edits):
                text[at] = rng.choice(["", "q", text[at] + "z"])
            changed = "".join(text)
            found = licences.searcher().find(f" aaa {changed} bbb ")
            assert any(f.label == label and f.edits <= distance(notice, changed) for f in found), (notice, changed)
    assert licences.searcher().find(" the quick brown fox licensed to run ") == []


def test_windows_reach_back_to_the_start_of_each_notice():
    """Edits that leave a seed standing by chance before the true one."""
    rng = random.Random(6)
    hard = ["licesed knder heoapachez license version 2 0"]
    label, notice = licences.NOTICES[0]
    for _ in range(3000):
        text = list(notice)
        for at in rng.sample(range(len(text)), rng.randrange(1, 6)):
            text[at] = rng.choice(["", rng.choice("abcdefghijklmnopqrstuvwxyz "), text[at] + rng.choice("abcdefghijklmnopqrstuvwxyz ")])
        hard.append(" ".join("".join(text).split()))
    own = licences.searcher()
    for text in hard:
        if distance(notice, text) <= licences.errors_for(notice):
            line = f" {'aaa ' * 20}{text} bbb "
            at = line.index(text)
            assert any(own._notices[n][0] == label and a <= at and b >= at + len(text) for n, a, b in own.windows(line)), text


def test_every_notice_of_a_joined_window_is_found():
    other, exact = "relesed into the pubic domain", "released into the public domain"
    for parts in ([other, exact], [other, other, exact, other], [exact] * 3):
        found = licences.scan_text(" ".join(parts))[-1]
        assert [(s["first_word"], s["end_word"]) for s in found if s["label"] == "public-domain"] == [(5 * i, 5 * i + 5) for i in range(len(parts))]


def test_many_faulty_notices_in_a_text_take_time_in_proportion():
    began = time.time()
    spans = licences.scan_text("all rights reservd and " * 20_000)[-1]
    assert [(s["first_word"], s["edits"]) for s in spans] == [(4 * i, 1) for i in range(20_000)] and time.time() - began < 30
    assert len(licences.scan_text("all rights all reserved rights " * 2_000)[-1]) <= 4_000


def test_spans_count_words():
    spans = licences.scan_text("One two. Released under the M1T License!")[-1]
    assert spans == [{"label": "mit", "first_word": 2, "end_word": 7, "edits": 1}]


def test_empty_table(spark):
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_labels_are_those_of_all_substrings():
    """A notice is found if and only if some stretch between word bounds lies within its errors, whatever stands around it."""
    rng = random.Random(8)
    own = licences.NoticeSearch((("mit", "released under the mit license"), ("cc-by", "licensed under cc by 4 0"), ("pd", "public domain")))
    words = ["released", "relesed", "under", "undr", "the", "teh", "mit", "m1t", "license", "licensed", "lisence", "cc", "by", "4", "0", "public", "pubic", "domain", "domains", "q"]
    for _ in range(120):
        line = f" {' '.join(rng.choices(words, k=rng.randrange(4, 12)))} "
        bounds = [m.start() for m in re.finditer(r"\b", line)]
        got = {f.label for f in own.find(line)}
        for label, length, k, _ in own._notices:
            notice = next(n for x, n in (("mit", "released under the mit license"), ("cc-by", "licensed under cc by 4 0"), ("pd", "public domain")) if x == label)
            near = any(distance(notice, line[a:b]) <= k for a in bounds for b in bounds if length - k <= b - a <= length + k)
            assert (label in got) == near, (line, label)
    for f in own.find(" x relesed undr the mit license y "):
        assert f.edits == distance("released under the mit license", " x relesed undr the mit license y "[f.start : f.end])


def test_the_likelier_of_overlapping_notices_counts():
    labels = lambda text: licences.scan_text(text)[5]
    assert labels("Licensed under CC BY-NC 4.0.") == "cc-by,cc-by-nc"  # cc by is a base phrase
    assert labels("Licensed under CC-BY-NC-SA 4.0") == "cc-by,cc-by-nc-sa"
    assert labels("licensed under a Creative Commons Attribution-ShareAlike") == "cc-by-sa"
    assert labels("Licensed under the GNU Lesser General Public License") == "gpl,lgpl"
    assert labels("Licensed under the GNU Affero Generel Public License") == "agpl"
