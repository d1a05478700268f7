"""Quality rules by weak supervision, in native expressions.

Rules vote for or against a document or abstain. Expectation maximisation over the counts of vote patterns estimates how often
each rule is right on good and on bad documents; the posterior probability of being good replaces an all-must-pass filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import GAP, WORD, stash

LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Bounds of a rule's accuracy, and of the share of good documents: no rule is certain, none worse than chance, and half of the
#: documents at least are good. Of a corpus that is mostly junk, give a lower bound of its own.
ACCURACY, GOOD = (0.55, 0.995), (0.5, 0.98)
#: EM ends where no probability moves by over 1e-9; in so many rounds at most, or else it is an error.
ROUNDS, KEEP = 5_000, 0.5


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, "-")
    return vote.otherwise("0") if good is None else vote.when(good, "+").otherwise("0")


def rules() -> dict[str, Column]:
    """Votes: - against, + for, 0 abstains. Repetition and length only speak against."""
    symbols, upper, marks = _share("n_symbols", "word_chars"), _share("n_upper", "word_chars"), _share("n_marks", "n_words")
    plain, stops, length = _share("n_plain", "n_words"), _share("n_stops", "n_words"), _share("word_chars", "n_words")
    return {
        "symbols": _vote(symbols > 0.05, symbols < 0.01),
        "plain_words": _vote(plain < 0.7, plain > 0.9),
        "capitals": _vote(upper > 0.3, upper < 0.1),
        "marks": _vote(marks > 0.2, marks < 0.1),
        "sentences": _vote(stops > 0.6, stops > 0.01),
        "word_length": _vote((length < 2.5) | (length > 9), (length > 3.5) & (length < 7)),
        "repeated_words": _vote(_share("n_repeat_words", "n_words") > 0.1),
        "repeated_lines": _vote(_share("n_dup_lines", "n_lines") > 0.3),
    }


def counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules need, of whole texts."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", text.alias("text"), F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    hashed = base.select("*", lines.alias("lines"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    n = F.size("words")
    h = F.col("h")
    window = lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).otherwise(F.array().cast("array<bigint>"))
    split = hashed.select("*", windows.alias("windows"))
    # only texts with a repeated window sort theirs: (hash, place) next to an equal hash is a repeated window
    placed = F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    sorted_ = split.select("*", F.when(repeated, placed).alias("s"))
    s = F.col("s")
    again = F.filter(s, lambda x, k: (F.get(s, k - 1)["x"] == x["x"]) | (F.get(s, k + 1)["x"] == x["x"]))
    starts = F.array_sort(F.transform(again, lambda x: x["i"]))
    found = sorted_.select("*", starts.alias("starts"))
    p = F.col("starts")
    # a start covers the words up to the next start, five at most
    covered = F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    long = {
        "n_words": n,
        "word_chars": F.length(F.regexp_replace("text", GAP, "")),
        "n_symbols": F.regexp_count("text", F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("lines"),
        "n_upper": F.regexp_count("text", F.lit(r"\p{Lu}")),
        "n_marks": F.regexp_count("text", F.lit("[!?]")),
        "n_stops": F.regexp_count("text", F.lit(r"[.!?](?=\s|$)")),
        "n_plain": F.size(F.filter("words", lambda w: w.rlike(r"^[\p{L}'’-]+[.,;:!?]?$"))),
    }
    return found.select("doc_id", *(c.cast("long").alias(k) for k, c in long.items()))


def posteriors(patterns: dict[str, int], within: tuple[float, float] = GOOD) -> tuple[dict[str, float], list[tuple[float, float]]]:
    """Probability of good for each vote pattern, and each rule's accuracies on (bad, good) documents, by EM from majority votes.

    A rule that votes is right with an accuracy of its own on good and on bad documents; abstaining tells nothing. The patterns
    number at most 3^rules, whatever the corpus. The share of good documents is kept `within` bounds.
    """
    if not patterns:
        return {}, []
    k, total = len(next(iter(patterns))), sum(patterns.values())
    side = {p: [(v == "+") - (v == "-") for v in p] for p in patterns}
    good = {p: (sum(v) > 0) + 0.5 * (sum(v) == 0) for p, v in side.items()}
    accuracy = [(ACCURACY[0], ACCURACY[0])] * k
    for _ in range(ROUNDS):
        prior = min(within[1], max(within[0], sum(good[p] * n for p, n in patterns.items()) / total))
        accuracy = []
        for j in range(k):
            right, votes = [1.0, 1.0], [2.0, 2.0]
            for p, n in patterns.items():
                if v := side[p][j]:
                    for y, share in ((0, 1 - good[p]), (1, good[p])):
                        votes[y] += share * n
                        right[y] += share * n * ((v > 0) == (y == 1))
            accuracy.append(tuple(min(ACCURACY[1], max(ACCURACY[0], r / v)) for r, v in zip(right, votes, strict=True)))
        now = {}
        for p, votes in side.items():
            odds = math.log(prior / (1 - prior))
            for (bad, fine), v in zip(accuracy, votes, strict=True):
                odds += (math.log(fine / (1 - bad)) if v > 0 else math.log((1 - fine) / bad)) if v else 0.0
            now[p] = 1 / (1 + math.exp(-odds))
        moved = max(abs(now[p] - good[p]) for p in patterns)
        good = now
        if moved < 1e-9:
            return good, accuracy
    raise RuntimeError(f"the accuracies of the rules haven't settled after {ROUNDS} rounds")


def judge(docs: DataFrame, share: tuple[float, float] = GOOD) -> DataFrame:
    """A row for each of `docs(doc_id, text)`: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, votes, probability.

    votes has a sign a rule, in the order of `rules`; kept is false for base_failed, else whether the posterior probability of
    good is at least one half. Accuracies are learned from all rows that pass the base, with a share of good ones within `share`:
    a corpus with fewer is judged as if it had the least, unless told so. Null and empty texts have no words and
    fail it. Repeated rows are judged each, alike. A text of any length is read whole and takes memory in proportion. Other columns
    of `docs` are ignored, whatever their names. An empty table gives no rows.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    voted = stash(counts(docs).withColumns({"base_failed": failed, "votes": F.concat(*rules().values())}))
    seen = voted.filter(~F.col("base_failed")).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    good, _ = posteriors({r["votes"]: r["n"] for r in seen}, share)
    known = docs.sparkSession.createDataFrame(sorted(good.items()), "votes string, probability double")
    kept = ~F.col("base_failed") & (F.col("probability") >= KEEP)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return voted.join(F.broadcast(known), "votes", "left").select(*columns, F.coalesce(kept, F.lit(False)).alias("kept"), "votes", "probability")
