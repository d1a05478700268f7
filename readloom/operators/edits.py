"""Edit distances of many pairs at once: a column of the matrix of distances is a few machine words of differences.

Myers' method in the form of Hyyrö: a step adds a letter of the longer text to 64 letters of the shorter one in some twenty operations
on words. Pairs of like length go together in arrays; what is too long or too rare for that goes by Python's integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of the shorter text up to which pairs go in arrays, pairs of an array, and its bytes.
WORDS, PAIRS, ROOM = 32, 4096, 1 << 21
_ONE = np.uint64(1)


def _matrix(texts: list[str], length: int) -> np.ndarray:
    """A column a text, a row a place; 0 behind a text's end."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), length), np.uint32)
    out[np.arange(length) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.ascontiguousarray(out.T)


def _one(short: str, long: str) -> int:
    """The distance of a pair, by integers of as many bits as the shorter text has letters."""
    places: dict[str, int] = {}
    for i, c in enumerate(short):
        places[c] = places.get(c, 0) | 1 << i
    m = len(short)
    whole, last, score = (1 << m) - 1, m - 1, m
    up, down = whole, 0
    for c in long:
        same = places.get(c, 0)
        x = same | down
        d = ((((same & up) + up) ^ up) | same) & whole
        higher, lower = down | (whole & ~(d | up)), up & d
        score += (higher >> last & 1) - (lower >> last & 1)
        higher = (higher << 1 | 1) & whole
        up, down = (lower << 1 & whole) | (whole & ~(x | higher)), higher & x
    return score


def _many(short: list[str], long: list[str], words: int) -> np.ndarray:
    """The distances of pairs whose shorter texts have 1 to 64 * words letters; the longer texts come by falling length."""
    m, n = np.fromiter(map(len, short), np.int64, len(short)), np.fromiter(map(len, long), np.int64, len(long))
    own, other = _matrix(short, int(m.max())), _matrix(long, int(n.max()))
    known = np.zeros(int(max(own.max(), other.max())) + 1, bool)
    known[own], known[0] = True, False
    number = np.cumsum(known) * known  # 0: in none of the shorter texts, or no letter
    own, other, letters, pairs = number[own], number[other], int(known.sum()) + 1, len(m)
    at = np.arange(pairs)
    places = np.zeros((words, letters, pairs), np.uint64)
    for i, row in enumerate(own):
        places[i // 64, row, at] |= _ONE << np.uint64(i % 64)
    places[:, 0] = 0
    flat = places.reshape(words, letters * pairs)
    up, down = np.full((words, pairs), ~np.uint64(0)), np.zeros((words, pairs), np.uint64)
    score, last, shift = m.copy(), (m - 1) // 64, ((m - 1) % 64).astype(np.uint64)
    mixed = [None if (last == w).all() else last == w for w in range(words)]
    going = np.searchsorted(-n, -np.arange(int(n.max())), "left")  # texts that are longer than j
    top = np.uint64(63)
    for j, k in enumerate(going.tolist()):
        index = other[j, :k] * pairs + at[:k]
        plus, minus = _ONE, np.uint64(0)
        for w in range(words):
            same, pv, mv = flat[w].take(index), up[w, :k], down[w, :k]
            x = same | mv
            same |= minus
            d = (((same & pv) + pv) ^ pv) | same
            higher, lower = mv | ~(d | pv), pv & d
            if mixed[w] is None or mixed[w].any():
                change = ((higher >> shift[:k]) & _ONE).view(np.int64) - ((lower >> shift[:k]) & _ONE).view(np.int64)
                score[:k] += change if mixed[w] is None else change * mixed[w][:k]
            p, q = higher >> top, lower >> top
            higher, lower = (higher << _ONE) | plus, (lower << _ONE) | minus
            up[w, :k], down[w, :k] = lower | ~(x | higher), higher & x
            plus, minus = p, q
    return score


def distances(first: list[str], second: list[str]) -> np.ndarray:
    """The edit distance of each pair, over code points."""
    out = np.zeros(len(first), np.int64)
    m, n = np.fromiter(map(len, first), np.int64, len(first)), np.fromiter(map(len, second), np.int64, len(second))
    short, long = np.minimum(m, n), np.maximum(m, n)
    out[short == 0] = long[short == 0]
    words = -(-short // 64)
    # up to four words apart, then by half powers of two: few sizes
    sized = np.where(words <= 4, words, 1 << np.ceil(np.log2(np.maximum(words, 1))).astype(np.int64))
    sized = np.where((sized > 4) & (words <= sized * 3 // 4), sized * 3 // 4, sized)
    pair = lambda i: (first[i], second[i]) if m[i] <= n[i] else (second[i], first[i])
    for size in np.unique(sized[short > 0]).tolist():
        rows = np.flatnonzero((sized == size) & (short > 0))
        rows = rows[np.argsort(-long[rows], kind="stable")]
        if size > WORDS or len(rows) < 10 * size:
            for i in rows.tolist():
                out[i] = _one(*pair(i))
            continue
        step = max(64, min(PAIRS, ROOM // (64 * size)))
        for a in range(0, len(rows), step):
            some = rows[a : a + step]
            ordered = [pair(i) for i in some.tolist()]
            out[some] = _many([s for s, _ in ordered], [t for _, t in ordered], size)
    return out


#: Radius up to which pairs go in bands of one word, pairs of a band's arrays, columns after which those too far apart are left out; letters that are numbered at once.
BAND, PAIRS_OF_BAND, COLUMNS, CHUNK = 32, 4096, 16, 1 << 20
_ALL, _TOP = ~np.uint64(0), np.uint64(1 << 63)


class Texts:
    """Texts that are compared many times: their letters as small numbers, end to end."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.sizes) - self.sizes
        whole = "".join(texts) or " "
        parts = lambda: (np.frombuffer(whole[a : a + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32) for a in range(0, len(whole), CHUNK))
        known = np.zeros(0x110000, bool)
        for codes in parts():
            known[codes] = True
        self.bits = max(1, (int(known.sum()) - 1).bit_length())
        number = (np.cumsum(known) - 1).astype(np.uint8 if self.bits <= 8 else np.uint32)
        self.letters = np.empty(len(whole), number.dtype)
        for i, codes in enumerate(parts()):
            self.letters[i * CHUNK : i * CHUNK + len(codes)] = number[codes]

    def columns(self, rows: np.ndarray, first: int, last: int) -> np.ndarray:
        """Letters `first` to `last` of some texts, a row a place; behind a text's end any letters."""
        at = self.starts[rows] + np.arange(first, last)[:, None]
        return self.letters.take(at, mode="clip")


def _alike(a: str, b: str, i: int, j: int, most: int) -> int:
    """How many letters are the same from a[i] and b[j] on, of `most`."""
    at, step = 0, 16
    while at + step <= most and a[i + at : i + at + step] == b[j + at : j + at + step]:
        at += step
        step *= 2
    step = min(step, most - at)
    while step:
        half = (step + 1) // 2
        if a[i + at : i + at + half] == b[j + at : j + at + half]:
            at += half
            step -= half
        else:
            step = half - 1
    return at


def _reached(short: str, long: str, radius: int) -> int:
    """The distance of a pair, or radius + 1 if it is more: by the furthest place on each diagonal, edit by edit, in time that grows with the radius, not with length."""
    m, n = len(short), len(long)
    end = n - m
    if short == long:
        return 0
    far = {0: _alike(short, long, 0, 0, m)}
    if not end and far[0] == m:
        return 0
    for e in range(1, radius + 1):
        now = {}
        for k in range(max(-e, end - radius + e), min(e, end + radius - e) + 1):
            i = max(far.get(k, -n) + 1, far.get(k - 1, -n), far.get(k + 1, -n) + 1)
            i = min(i, m, n - k)
            if i < 0 or i + k < 0:
                continue
            if i < m and i + k < n and short[i] == long[i + k]:
                i += _alike(short, long, i, i + k, min(m - i, n - i - k))
            now[k] = i
        if now.get(end) == m:
            return e
        far = now
    return radius + 1


def _in_band(texts: Texts, short: np.ndarray, long: np.ndarray, radius: int) -> np.ndarray:
    """The distances of pairs of like length, or radius + 1 if more; the longer texts come by falling length.

    A word holds 64 rows of a column, which go down by one a column, around the diagonal that the last place is on. Distances along
    that never fall, so a pair is left out as soon as it is over the radius there; few pairs that stay go by `_reached`.
    """
    out = np.full(len(short), radius + 1, np.int64)
    left, n = np.arange(len(short)), texts.sizes[long]
    shift = (BAND - (n - texts.sizes[short])).astype(np.uint64)
    bits = [np.array([c >> b & 1 for c in range(1 << texts.bits)], np.uint64) for b in range(texts.bits)]
    tops, wholes = [x * _TOP for x in bits], [x * _ALL for x in bits]
    planes = [np.zeros(len(short), np.uint64) for _ in bits]
    for row in texts.columns(short, 0, BAND - 1):
        for b, top in enumerate(tops):
            planes[b] = (planes[b] >> _ONE) | top.take(row)
    up, down, same_of = np.full(len(short), _ALL << np.uint64(BAND)), np.zeros(len(short), np.uint64), np.zeros(len(short), np.uint64)
    j = 0
    while len(left):
        most = int(n[0])
        if len(left) * 20 < most - j:
            for i in left.tolist():
                out[i] = _reached(texts.texts[short[i]], texts.texts[long[i]], radius)
            break
        last = min(j + COLUMNS, most)
        entering, letter = texts.columns(short[left], j + BAND - 1, last + BAND - 1), texts.columns(long[left], j, last)
        entering, letter = [t.take(entering) for t in tops], [w.take(letter) for w in wholes]
        going = np.searchsorted(-n, -np.arange(j + 1, last + 1), "right").tolist()
        for at, k in enumerate(going):
            j += 1
            same = None
            for b, plane in enumerate(planes):
                p = plane[:k]
                p >>= _ONE
                p |= entering[b][at, :k]
                other = p ^ letter[b][at, :k]
                same = other if same is None else np.bitwise_or(same, other, out=same)
            np.invert(same, out=same)
            if j <= BAND:  # rows before the first letter are like none
                same &= _ALL << np.uint64(BAND + 1 - j)
            pv, mv = up[:k], down[:k]
            d = same & pv
            d += pv
            d ^= pv
            d |= same
            d |= mv
            higher = d | pv
            np.invert(higher, out=higher)
            higher |= mv
            np.bitwise_and(d, pv, out=pv)  # lower
            same = d >> shift[:k]
            same &= _ONE
            same_of[:k] += same
            d >>= _ONE
            np.bitwise_and(d, higher, out=mv)
            d |= higher
            np.invert(d, out=d)
            pv |= d
        score = np.minimum(n, j) - same_of.view(np.int64)
        done = n <= j
        out[left[done]] = np.minimum(score[done], radius + 1)
        stay = np.flatnonzero(~done & (score <= radius))
        if len(stay) < len(left):
            left, n, shift, up, down, same_of = (x[stay] for x in (left, n, shift, up, down, same_of))
            planes = [p[stay] for p in planes]
    return out


def within(texts: Texts, first: np.ndarray, second: np.ndarray, radius: int) -> np.ndarray:
    """The edit distance of pairs of `texts`, by their numbers; radius + 1 where it is more."""
    turned = texts.sizes[first] > texts.sizes[second]
    short, long = np.where(turned, second, first), np.where(turned, first, second)
    out = np.full(len(first), radius + 1, np.int64)
    rows = np.flatnonzero(texts.sizes[long] - texts.sizes[short] <= radius)
    if radius > BAND or texts.bits > 8:
        for i in rows.tolist():
            out[i] = _reached(texts.texts[short[i]], texts.texts[long[i]], radius)
        return out
    rows = rows[np.argsort(-texts.sizes[long[rows]], kind="stable")]
    for a in range(0, len(rows), PAIRS_OF_BAND):
        some = rows[a : a + PAIRS_OF_BAND]
        out[some] = _in_band(texts, short[some], long[some], radius)
    return out


@F.pandas_udf(T.IntegerType())
def _distance(first: pd.Series, second: pd.Series) -> pd.Series:
    there = (first.notna() & second.notna()).to_numpy()
    out = pd.Series(pd.NA, index=first.index, dtype="Int32")
    if there.any():
        out[there] = distances(first[there].tolist(), second[there].tolist())
    return out


def edit_distance(first: Column, second: Column) -> Column:
    """The edit distance of two texts, as `levenshtein` gives it, many at a call; null where one is null."""
    return _distance(first, second)
