"""Licence scans: exact phrases, and fuzzy search for short notices.

A notice that may have k errors is split into k + 1 seeds; one of them must stand exactly wherever the notice does (pigeonhole).
One automaton finds the seeds of all notices, and the regex library's bounded-error matching checks the text around each and
gives the span and its edits.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from readloom.llm.common import filled_id, restored_id

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Short notices of public licences by label, as words.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "spdx license identifier apache 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "distributed under the license is distributed on an as is basis"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "spdx license identifier mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("isc", "licensed under the isc license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "use of this source code is governed by a bsd style license"),
    ("bsd", "licensed under the 3 clause bsd license"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("gpl", "either version 2 of the license or at your option any later version"),
    ("gpl", "spdx license identifier gpl 3 0 or later"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("lgpl", "spdx license identifier lgpl 2 1"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "licensed under the mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license"),
    ("cddl", "subject to the terms of the common development and distribution license"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("artistic", "licensed under the artistic license 2 0"),
    ("ofl", "licensed under the sil open font license"),
    ("gfdl", "under the terms of the gnu free documentation license"),
    ("odbl", "made available under the open database license"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal"),
    ("cc-by", "licensed under a creative commons attribution"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under a creative commons attribution noderivatives"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4 0"),
    ("public-domain", "released into the public domain"),
    ("public-domain", "this work is in the public domain"),
    ("reserved", "all rights reserved"),
    ("proprietary", "proprietary and confidential unauthorized copying of this file"),
)
#: A notice may have one error in this many characters, and so many at most: bounded-error matching gets slow beyond.
CHARS_AN_ERROR, MOST_ERRORS = 8, 5
#: All bytes that part words become spaces, capitals become small; bytes of other characters stay.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def places(line: bytes, phrase: bytes) -> list[int]:
    """Numbers of the words at which a phrase starts in a line of words that are parted, begun and ended by single spaces."""
    out, at, words, seen = [], line.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        words, seen = words + line.count(b" ", seen, at), at
        out.append(words)
        at = line.find(b" " + phrase + b" ", at + 1)
    return out


@dataclass(frozen=True)
class Found:
    label: str
    start: int
    end: int
    edits: int
    likeness: float


def errors_for(notice: str, chars_an_error: int = CHARS_AN_ERROR, most_errors: int = MOST_ERRORS) -> int:
    return min(most_errors, len(notice) // chars_an_error)


def seeds_of(notice: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 parts of the notice with their places."""
    cuts = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class NoticeSearch:
    def __init__(self, notices: tuple[tuple[str, str], ...] = NOTICES, chars_an_error: int = CHARS_AN_ERROR, most_errors: int = MOST_ERRORS) -> None:
        import ahocorasick
        import regex

        self._notices, self._any, of_seed = [], [], {}
        for label, notice in notices:
            k = errors_for(notice, chars_an_error, most_errors)
            pattern = rf"\b(?:{regex.escape(notice)}){{e<={k}}}\b"
            self._notices.append((label, len(notice), k, regex.compile(f"(?b){pattern}")))
            self._any.append(regex.compile(pattern))
            for at, seed in seeds_of(notice, k):
                of_seed.setdefault(seed, []).append((len(self._notices) - 1, at))
        self._seeds = ahocorasick.Automaton()
        for seed, owners in of_seed.items():
            self._seeds.add_word(seed, (len(seed), owners))
        self._seeds.make_automaton()

    def windows(self, line: str) -> Iterator[tuple[int, int, int]]:
        """Where each notice may stand: (notice, start, end), overlapping places joined."""
        held: dict[int, list[tuple[int, int]]] = {}
        for last, (size, owners) in self._seeds.iter(line):
            for notice, at in owners:
                _, length, k, _ = self._notices[notice]
                start = last + 1 - size - at
                held.setdefault(notice, []).append((max(0, start - k - 1), start + length + k + 1))
        for notice, own in held.items():
            own.sort()  # a later seed may stand for an earlier start
            start, end = own[0]
            for a, b in own[1:]:
                if a > end:
                    yield notice, start, end
                    start = a
                end = max(end, b)
            yield notice, start, end

    def _matches(self, notice: int, line: str, start: int, end: int) -> Iterator[object]:
        """Matches of a notice in a stretch that don't overlap, the best of overlapping ones.

        From the first place that matches at all, the best match nearby is taken, and a better one that overlaps it instead, as
        long as there is one: each has fewer edits, so what is looked at is bounded, and the search goes on behind it.
        """
        _, length, k, best = self._notices[notice]
        reach = length + k

        def near(low: int, high: int) -> object:
            after = line.find(" ", high, end)  # a stretch that ended within a word would end a match there
            return best.search(line, max(start, low), end if after < 0 else after)

        while end - start >= length - k and (first := self._any[notice].search(line, start, end)):
            start = first.start()
            m, better = None, near(start, start + 2 * reach) or first
            while m is None or sum(better.fuzzy_counts) < sum(m.fuzzy_counts):
                m = better
                better = near(m.start() - reach, m.end() + reach) or m
            left = [(start, m.start())]
            while left:  # others before it
                a, b = left.pop()
                if b - a >= length - k and (other := best.search(line, a, b)):
                    yield other
                    left += [(a, other.start()), (other.end(), b)]
            yield m
            start = m.end()

    def find(self, line: str) -> list[Found]:
        out = set()
        for notice, start, end in self.windows(line):
            label, length, _, _ = self._notices[notice]
            for m in self._matches(notice, line, start, min(end, len(line))):
                edits = sum(m.fuzzy_counts)
                out.add(Found(label, m.start(), m.end(), edits, 1 - edits / length))
        return sorted(out, key=lambda f: (f.start, f.end, f.label))


#: Characters of a stretch by which finds are looked up.
STRETCH = 256


def best_of(found: list[Found]) -> list[Found]:
    """Without those that overlap a likelier notice, or stand within a longer one that is as likely. Only finds that share a stretch are compared."""
    kept: dict[int, list[Found]] = {}
    out = []
    for f in sorted(found, key=lambda f: (-f.likeness, f.start - f.end, f.start, f.label)):
        stretches = range(f.start // STRETCH, f.end // STRETCH + 1)
        near = [k for s in stretches for k in kept.get(s, ()) if f.start < k.end and k.start < f.end]
        if not any(k.likeness > f.likeness or k.start <= f.start and f.end <= k.end and k.end - k.start > f.end - f.start for k in near):
            out.append(f)
            for s in stretches:
                kept.setdefault(s, []).append(f)
    return sorted(out, key=lambda f: (f.start, f.end, f.label))


@functools.cache
def searcher(chars_an_error: int = CHARS_AN_ERROR, most_errors: int = MOST_ERRORS) -> NoticeSearch:
    return NoticeSearch(chars_an_error=chars_an_error, most_errors=most_errors)


def scan_text(text: str | None, chars_an_error: int = CHARS_AN_ERROR, most_errors: int = MOST_ERRORS) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of a whole text."""
    words = words_of(text)
    line = b" " + b" ".join(words) + b" "
    base = {label: places(line, phrase.encode()) for phrase, label in PHRASES.items()}
    starts = [p for own in base.values() for p in own]
    base_labels = sorted({label for label, own in base.items() if own})
    string = line.decode("utf-8", "replace")
    found = best_of(searcher(chars_an_error, most_errors).find(string))
    labels = sorted({*base_labels, *(f.label for f in found)})
    spans, seen, first = [], 0, -1
    for f in found:
        first += string.count(" ", seen, f.start + 1)
        seen = f.start + 1
        spans.append({"label": f.label, "first_word": first, "end_word": first + string[f.start : f.end].strip().count(" ") + 1, "edits": f.edits})
    score = 1.0 if starts else max((f.likeness for f in found), default=0.0)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(base_labels), ",".join(labels), score, spans)


def scan(docs: DataFrame, chars_an_error: int = CHARS_AN_ERROR, most_errors: int = MOST_ERRORS) -> DataFrame:
    """A row for each of `docs(doc_id, text)`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Base: places of exact phrases; first_word and last_word are null without any. labels adds those of notices found with at
    most one error in `chars_an_error` characters and `most_errors` in all, where no likelier notice stands; spans has their words and edits. score is 1 for a base phrase, else the likeness of the
    best notice, else 0. Null and empty texts have no words and no labels. Very long texts are scanned whole, in time that grows with their length. Repeated rows are
    scanned each. Other columns of `docs` are ignored, whatever their names. An empty table gives no rows.
    """
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([scan_text(t, chars_an_error, most_errors) for t in batch["text"]], columns=names)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"}).assign(doc_id=batch["doc_id"].to_numpy())

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, first_word: long, end_word: long, edits: int>>"
    )
    scanned = docs.select(filled_id().alias("doc_id"), "text").mapInPandas(run, schema)
    return scanned.select(restored_id(), *names)
