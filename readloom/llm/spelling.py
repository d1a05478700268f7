"""Spelling variants: words of a vocabulary that differ by one code point, and the commoner form that each follows.

In a block of the vocabulary, one bitset for each (position, letter) says which words have the letter there. A word is followed
letter by letter through all words of its block at once: one set has those without an error so far, three those with one
(another letter, one more here, one more there), which go on with the same or the next position's bitset.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import LOWER, UPPER, stash
from readloom.operators.groups import bounds, by_group

#: Fixed value: the letters of a word, as a character class.
LETTERS = r"A-Za-zÀ-ÿ"
#: Letters, of what its words don't share by its key, that a block has before it is keyed anew: they bound its bitsets.
BLOCK = 65_536
#: Machine words that are compared at once.
AT_ONCE = 1 << 16
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def vocabulary(docs: DataFrame, least_letters: int = 6, least_count: int = 5, slip: int | None = 199) -> DataFrame:
    """Columns word, n of the words of `docs(doc_id, text)` with as many letters and occurrences: runs of LETTERS, A-Z in lower case.

    Where `slip` divides the CRC-32 of `<doc_id>:<run>`, the run loses the letter at that number modulo its length. Shorter runs
    can't become words and aren't taken out of the text. Occurrences are counted before they are shuffled.
    """
    text = F.translate("text", UPPER, LOWER)
    run = F.col("run")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(f"([{LETTERS}]{{{least_letters},}})"))).alias("run"))
    word = run
    if slip is not None:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run))
        at = (h % F.length(run)).cast("int")
        word = F.when(h % slip == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)
    words = runs.select(word.alias("word")).filter(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _half(free: Column) -> Column:
    return F.floor(free / 2).cast("int")


def _key(first: Column, last: Column, limit: Column) -> Column:
    return F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"), limit.cast("int").alias("limit"))


def _keyed(words: DataFrame, least_letters: int) -> DataFrame:
    """Each word under four keys: one code point between two words, of which the shorter has `short` letters, leaves them the
    first half of these in common, or else the second.

    `first` and `last` letters are common, and the pair has fewer than `limit` first letters in common (those with more meet by
    their first half).
    """
    short = F.explode(F.array_distinct(F.array(F.greatest(F.lit(least_letters), F.length("word") - 1), F.length("word"))))
    each = words.select("word", "n", short.alias("short"))
    half = _half(F.col("short"))
    keys = F.array(_key(half, F.lit(0), F.lit(None)), _key(F.lit(0), F.col("short") - half, half))
    return _celled(each.select("word", "n", "short", F.inline(keys)))


def _halved(rows: DataFrame) -> DataFrame:
    """The same argument for what the words of a key don't share."""
    half = _half(F.col("short") - F.col("first") - F.col("last"))
    first, middle = F.col("first"), F.col("first") + half
    keys = F.array(_key(middle, F.col("last"), F.col("limit")), _key(first, F.col("short") - middle, middle))
    return _celled(rows.select("word", "n", "short", F.inline(keys)))


def _celled(rows: DataFrame) -> DataFrame:
    word, length = F.col("word"), F.length("word")
    common = (F.substring(word, F.lit(1), F.col("first")), F.substring(word, length - F.col("last") + 1, F.col("last")))
    free = F.substring(word, F.col("first") + 1, length - F.col("first") - F.col("last"))
    return rows.select(F.concat_ws("|", "short", "first", "last", *common).alias("cell"), "word", "n", "short", "first", "last", "limit", free.alias("free"))


def blocks(words: DataFrame, least_letters: int, block: int = BLOCK) -> DataFrame:
    """Rows (cell, word, n, own, limit) of cells that hold together, once, any two of `words(word, n)` that one code point parts.

    `own` is what a word doesn't share by the key, limit as in `_keyed` but within it. A cell with over `block` letters of these
    is keyed anew, halving what is not shared, so that in the end a letter or two are free: as many words as two letters make.
    """
    rows, found = _keyed(words, least_letters), None
    while True:
        weight = rows.groupBy("cell").agg(F.sum(F.length("free")).alias("_weight"), F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
        dealt = stash(rows.join(weight, "cell"))
        large = (F.col("_weight") > block) & (F.col("short") - F.col("first") - F.col("last") > 1)
        own = dealt.filter(~large).select("cell", "word", "n", F.col("free").alias("own"), (F.col("limit") - F.col("first")).alias("limit"), (F.length("word") > F.col("short")).alias("longer"))
        found = own if found is None else found.unionByName(own)
        left = dealt.filter(large)
        if left.isEmpty():
            return found
        rows = _halved(left)


def _lanes(codes: np.ndarray, lengths: np.ndarray, starts: np.ndarray, letters: int) -> np.ndarray:
    """Bitsets by position (one before the first and two after the last are empty) and letter: bit i is the i-th word's."""
    n = len(lengths)
    lane = np.repeat(np.arange(n), lengths)
    position = np.arange(len(codes)) - np.repeat(starts, lengths)
    index = np.zeros(((int(lengths.max(initial=0)) + 3) * letters, (n + 63) // 64), np.uint64)
    np.bitwise_or.at(index, ((position + 1) * letters + codes, lane // 64), np.uint64(1) << (lane % 64).astype(np.uint64))
    return index


def _set_of(members: np.ndarray) -> np.ndarray:
    bits = np.zeros((len(members) + 63) // 64 * 64, bool)
    bits[: len(members)] = members
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _near(index: np.ndarray, letters: int, queries: np.ndarray, same: np.ndarray, shorter: np.ndarray, longer: np.ndarray, limit: int | None) -> np.ndarray:
    """For each of `queries` (rows of letters, all of one length) the set of words that one code point parts from it: of equal
    length among `same`, one shorter among `shorter`, one longer among `longer`; with fewer than `limit` first letters in common."""
    n, length = queries.shape
    exact = np.full((n, index.shape[1]), _ALL)
    other, extra, missing = (np.zeros_like(exact) for _ in range(3))
    alike = None
    for j in range(length + 1):
        if j == limit:
            alike = exact
        if j == length:
            break
        before, here, after = (index[(j + d) * letters + queries[:, j]] for d in (0, 1, 2))
        other = (other & here) | (exact & ~here)
        extra = (extra & before) | exact
        missing = (missing | exact) & after
        exact = exact & here
    found = (other & same) | (extra & shorter) | ((missing | exact) & longer)
    return found if alike is None else found & ~alike


def _first_lane(sets: np.ndarray) -> np.ndarray:
    word = (sets != 0).argmax(axis=1)
    low = sets[np.arange(len(sets)), word]
    return word * 64 + np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1))


def _neighbours(cells: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """word, n_near, form, form_n for the words of cells, sorted by falling n and word: so the first bit of a set is the form's."""
    own = cells["own"].to_numpy()
    length = np.fromiter(map(len, own), np.int64, len(own))
    _, code = np.unique(np.frombuffer("".join(own).encode("utf-32-le"), np.uint32), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(length)])
    longer, limits = cells["longer"].to_numpy(), cells["limit"].to_numpy(float, na_value=np.nan)
    rows, near, best = [], [], []
    edges = bounds(cells["cell"].to_numpy())
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if longer[start:end].all():  # words of one letter more meet under their own length
            continue
        kinds, codes = np.unique(code[at[start] : at[end]], return_inverse=True)
        letters, mine, size = max(1, len(kinds)), longer[start:end], length[start:end]
        index = _lanes(codes, size, at[start:end] - at[start], letters)
        limit = None if np.isnan(limits[start]) else int(limits[start])
        short, long, none = _set_of(~mine), _set_of(mine), _set_of(np.zeros(end - start, bool))
        for group, same, shorter, longer_ones in ((np.flatnonzero(~mine), short, none, long), (np.flatnonzero(mine), none, short, none)):
            step = max(1, AT_ONCE // index.shape[1])
            for i in range(0, len(group), step):
                part = group[i : i + step]
                places = (at[start:end] - at[start])[part][:, None] + np.arange(size[part[0]])
                sets = _near(index, letters, codes[places], same, shorter, longer_ones, limit)
                count = np.bitwise_count(sets).sum(axis=1)
                hit = np.flatnonzero(count)
                rows.append(start + part[hit])
                near.append(count[hit])
                best.append(start + _first_lane(sets[hit]))
    if rows:
        rows, best = np.concatenate(rows), np.concatenate(best)
        word, n = cells["word"].to_numpy(), cells["n"].to_numpy()
        yield pd.DataFrame({"word": word[rows], "n_near": np.concatenate(near).astype(np.int64), "form": word[best], "form_n": n[best]})


def near_words(words: DataFrame, least_letters: int = 6, block: int = BLOCK) -> DataFrame:
    """word, n_near, form, form_n: of `words(word, n)` that have any, how many near words and the one of largest n, of equals the
    smallest in code-point order. A pair meets in one cell, so cells' counts add up; pairs are never rows."""
    order = [F.desc("n"), "word"]
    each = by_group(blocks(words, least_letters, block), "cell", order, _neighbours, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form")))
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """word, root of `links(word, form)`, which have no circle: each step doubles the links that a word has followed."""
    at = stash(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if at.join(ahead, "root", "left_semi").isEmpty():
            return at
        at = stash(at.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root")))


def variants(docs: DataFrame, least_letters: int = 6, least_count: int = 5, times: int = 5, slip: int | None = 199) -> DataFrame:
    """Columns word, form, root, n, n_near, form_n of every word of `docs(doc_id, text)`, see `vocabulary`.

    Near words differ by one code point: another one, one more or one less. A word's form is its near word of largest n, if it has
    `times` its own n at least; root is where forms lead, the word itself if it has none. As n grows by `times` at each form, few
    steps end at the root.

    Null and empty texts have no words; a null doc_id counts as an empty string in `slip`'s hash; repeated rows count again. A
    text, and a word, may be of any length. An empty table, or one without words, gives no rows. Other columns are ignored.
    """
    words = stash(vocabulary(docs, least_letters, least_count, slip))
    found = words.join(near_words(words, least_letters), "word", "left")
    taken = F.col("form_n") >= times * F.col("n")
    named = stash(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("form")).alias("form"), F.when(taken, F.col("form_n")).alias("form_n")))
    ends = roots(named.filter("form IS NOT NULL"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
