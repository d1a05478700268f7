import random
import re

import pytest

from readloom.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = len(lines) - len(set(lines))
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_base_matches_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        pool = [f"w{k}" for k in range(rng.choice((2, 6, 400)))]
        text = "".join(rng.choice(pool) + rng.choice([" ", " ", "\n", "\x0b", " # ", "\n\n", "é𝄞 "]) for _ in range(rng.randrange(0, 90)))
        rows.append((i, text, "x", 1))
    rows += [(900, None, None, None), (901, "", None, None), (902, "a b c d e " * 30, None, None), (903, "a\n" * 7, None, None), (None, "one", None, None), rows[0]]
    rows.append((904, " ".join(f"v{i}" for i in range(20000)) + " v5 v6 v7 v8 v9", None, None))
    out = rules.judge(spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")).collect()
    assert len(out) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        if r.doc_id != 904:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id]), texts[r.doc_id]
        else:
            assert (r.n_words, r.n_repeat_words) == (20005, 10)
        assert not (r.kept and r.base_failed)


def test_em_learns_which_rules_are_right():
    rng = random.Random(2)
    accuracy, patterns, truth = [0.95, 0.9, 0.9, 0.6, 0.85], {}, {}
    for _ in range(6000):
        good = rng.random() < 0.8
        votes = "".join("0" if rng.random() < 0.2 else "+" if (rng.random() < a) == good else "-" for a in accuracy)
        patterns[votes] = patterns.get(votes, 0) + 1
        truth.setdefault(votes, []).append(good)
    posterior, learned = rules.posteriors(patterns)
    for (bad, fine), a in zip(learned, accuracy, strict=True):
        assert abs(fine - a) < 0.06 and abs(bad - a) < 0.12
    right = sum((posterior[p] >= 0.5) == t for p, own in truth.items() for t in own)
    majority = sum((p.count("+") >= p.count("-")) == t for p, own in truth.items() for t in own)
    assert right >= majority and right / 6000 > 0.93
    assert rules.posteriors({}) == ({}, [])


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(3)
    prose = lambda: [" ".join(rng.choices(["the", "river", "runs", "over", "stones", "and", "sleeps"], k=7)).capitalize() + "." for _ in range(6)]
    rows = [(i, " ".join(prose())) for i in range(200)]
    rows += [(1000 + i, " ".join(w + "$$$" for w in " ".join(prose()).split())) for i in range(20)]
    rows += [(2000 + i, " ".join(w.upper() + "!!" for w in " ".join(prose()).split())) for i in range(20)]
    out = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i].kept for i in range(200) if not out[i].base_failed) and not any(out[i].kept for i in out if i >= 1000)


def test_empty_table(spark):
    assert rules.judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_kept_is_what_em_by_hand_says(spark):
    """EM over documents one by one, from the votes that `judge` returns."""
    rng = random.Random(7)
    prose = lambda: " ".join(" ".join(rng.choices(["the", "river", "runs", "over", "stones", "sleeps"], k=7)).capitalize() + rng.choice([".", "!", " $#"]) for _ in range(5))
    rows = [(i, prose() if i % 4 else " ".join(rng.choice([str.upper, str])(w) + rng.choice(["", "!!", "$$$"]) for w in prose().split())) for i in range(400)]
    out = [r for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    own = [r for r in out if not r.base_failed]
    votes = [[{"+": 1, "-": -1, "0": 0}[v] for v in r.votes] for r in own]
    good = [1.0 if sum(v) > 0 else 0.5 if sum(v) == 0 else 0.0 for v in votes]
    for _ in range(rules.ROUNDS):
        prior = min(rules.GOOD[1], max(rules.GOOD[0], sum(good) / len(good)))
        right = []
        for j in range(len(votes[0])):
            fine = (1 + sum(g for g, v in zip(good, votes) if v[j] == 1)) / (2 + sum(g for g, v in zip(good, votes) if v[j]))
            bad = (1 + sum(1 - g for g, v in zip(good, votes) if v[j] == -1)) / (2 + sum(1 - g for g, v in zip(good, votes) if v[j]))
            right.append([min(rules.ACCURACY[1], max(rules.ACCURACY[0], p)) for p in (bad, fine)])
        for i, own_votes in enumerate(votes):
            y1, y0 = prior, 1 - prior
            for (bad, fine), v in zip(right, own_votes):
                y1 *= {1: fine, -1: 1 - fine, 0: 1}[v]
                y0 *= {1: 1 - bad, -1: bad, 0: 1}[v]
            good[i] = y1 / (y1 + y0)
    for r, g in zip(own, good):
        assert abs(r.probability - g) < 1e-5 and (r.kept == (g >= rules.KEEP) or abs(g - rules.KEEP) < 1e-5)
    assert {r.kept for r in own} == {True, False}


def test_an_em_that_does_not_settle_is_an_error(monkeypatch):
    monkeypatch.setattr(rules, "ROUNDS", 2)
    with pytest.raises(RuntimeError, match="settled"):
        rules.posteriors({"+-0": 40, "-++": 31, "++-": 22, "--+": 9})


def test_the_share_of_good_documents_is_an_argument():
    junk = {"---": 90, "+++": 10}
    shares = [sum(good[p] * n for p, n in junk.items()) / 100 for good in (rules.posteriors(junk, share)[0] for share in ((0.5, 0.98), (0.02, 0.98)))]
    assert abs(shares[1] - 0.1) < 0.01 and shares[0] >= shares[1]
