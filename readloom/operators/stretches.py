"""K-mers that meet others without a row for each: consecutive ones go as one stretch of letters to where their least m-mer sends them.

The least m-mer (by a hash) of a k-mer is a matter of its letters alone, so equal k-mers fall into one bucket; neighbours mostly have
the same one, so a sequence is shuffled as a few times its own letters, not as k times. Within a bucket k-mers are numbers in arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions.tables import SIMPLE_FROM, SIMPLE_TO
from readloom.operators.groups import by_group

#: Letters that are looked at together, and the most of an m-mer.
PIECE, LONGEST = 1 << 18, 16
_BASES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_COMPLEMENT = str.maketrans(SIMPLE_FROM, SIMPLE_TO)


def letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def hashes(codes: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """A hash of each k letters that follow one another: from hashes of 1, 2, 4, ... letters, mixed in the end."""
    base = power = _BASES[which : which + 1]
    part, done, size, found = codes + np.uint64(1), 0, 1, None
    n = len(codes) - k + 1
    while True:
        if k & size:
            own = part[done : done + n]
            found = own if found is None else found * power + own
            done += size
        if done == k:
            break
        part = part[: len(part) - size] * power + part[size:]
        power, size = power * power, 2 * size
    found = (found ^ (found >> np.uint64(31))) * base
    return found ^ (found >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values that follow one another."""
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    more = width - size
    return np.minimum(values[:-more], values[more:]) if more else values


def _laid(texts: list[str], k: int) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The texts end to end; of each k-mer within one of them its place there, the number of its text, and its place in that."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    own = sizes - k + 1
    text = np.repeat(np.arange(len(texts)), own)
    within = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    return "".join(texts), np.repeat(np.cumsum(sizes) - sizes, own) + within, text, within


def _cut(texts: list[str], k: int, both_ways: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Of each stretch of the texts (of k letters at least) its bucket, the number of its text, its place there, and its letters."""
    m = max(1, min(LONGEST, 2 * k // 5))
    whole, places, text, within = _laid(texts, k)
    own = hashes(letters(whole), m)
    if both_ways:
        own = np.minimum(own, hashes(letters(whole.translate(_COMPLEMENT))[::-1], m)[::-1])
    least = _least(own, k - m + 1)[places]
    first = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])]))
    start = places[first]
    end = start + np.diff(np.append(first, len(places))) + k - 1
    return least[first].view(np.int64), text[first], within[first], [whole[i:j] for i, j in zip(start.tolist(), end.tolist(), strict=True)]


def _pieces(texts: list[str], k: int) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """The texts, long ones in pieces that share k - 1 letters, some at a time: number of the text, place there, letters."""
    numbers, places, parts, held = [], [], [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text) - k + 1, PIECE):
            part = text[at : at + PIECE + k - 1]
            numbers.append(number), places.append(at), parts.append(part)
            held += len(part)
            if held >= PIECE:
                yield numbers, places, parts
                numbers, places, parts, held = [], [], [], 0
    if parts:
        yield numbers, places, parts


def stretches(seqs: DataFrame, key: str, k: int, both_ways: bool = False) -> DataFrame:
    """bucket, key (as text), at (from 0), letters: all k-mers of `seqs(key, seq)`, those of one least m-mer together.

    Equal k-mers are in one bucket; `both_ways`: reverse complements too.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["key"].to_numpy(object)
            for numbers, places, parts in _pieces(batch["seq"].tolist(), k):
                bucket, part, within, found = _cut(parts, k, both_ways)
                yield pd.DataFrame({"bucket": bucket, "key": keys[np.array(numbers)[part]], "at": np.array(places)[part] + within, "letters": found})

    whole = seqs.filter(F.length("seq") >= k).select(F.col(key).cast("string").alias("key"), "seq")
    return whole.mapInPandas(run, "bucket long, key string, at long, letters string")


def placed(reads: DataFrame, contigs: DataFrame, k: int) -> DataFrame:
    """contig, start, n: how many of `reads(seq)` of k letters stand at each place of `contigs(contig, seq)`, in either orientation.

    A hash finds the places; the letters themselves decide.
    """

    def run(groups: pd.DataFrame) -> Iterator[pd.DataFrame]:
        is_read = groups["key"].isna().to_numpy()
        table: dict[str, int] = {}
        for read in groups["letters"][is_read]:
            if "N" not in read:
                for text in (read, read.translate(_COMPLEMENT)[::-1]):
                    table[text] = table.get(text, 0) + 1
        own = groups[~is_read]
        if not table or not len(own):
            return
        known = np.unique(hashes(letters("".join(table)), k)[::k])
        whole, places, text, within = _laid(own["letters"].tolist(), k)
        at = hashes(letters(whole), k)[places]
        hits = np.flatnonzero(known[np.minimum(np.searchsorted(known, at), len(known) - 1)] == at)
        n = np.fromiter((table.get(whole[p : p + k], 0) for p in places[hits].tolist()), np.int64, len(hits))
        hits, n = hits[n > 0], n[n > 0]
        yield pd.DataFrame({"contig": own["key"].to_numpy()[text[hits]], "start": own["at"].to_numpy()[text[hits]] + within[hits], "n": n})

    cut = stretches(contigs.filter("contig IS NOT NULL"), "contig", k, both_ways=True)
    asked = stretches(reads.filter(F.length("seq") == k).select(F.lit(None).cast("string").alias("key"), "seq"), "key", k, both_ways=True)
    found = by_group(cut.unionByName(asked), "bucket", [], run, "contig string, start long, n long")
    return found.groupBy(F.col("contig").cast(contigs.schema["contig"].dataType).alias("contig"), "start").agg(F.sum("n").alias("n"))


def _spread(key: str) -> tuple[int, int]:
    digest = hashlib.blake2b(key.encode(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")


def owner_classes(seqs: DataFrame, key: str, k: int) -> DataFrame:
    """key, first, members, kmers: a row for each member of each class of k-mers that the same several keys have.

    K-mers are told apart by 128 bits of hash, sets of owners by their number and two sums of hashes of the owners.
    """
    number = isinstance(seqs.schema[key].dataType, T.IntegralType)

    def run(groups: pd.DataFrame) -> Iterator[pd.DataFrame]:
        owner, names = pd.factorize(groups["key"])
        if len(names) < 2:
            return
        whole, places, text, _ = _laid(groups["letters"].tolist(), k)
        codes = letters(whole)
        one, two, own = hashes(codes, k)[places], hashes(codes, k, 1)[places], owner[text]
        order = np.lexsort((own, two, one))
        one, two, own = one[order], two[order], own[order]
        other = np.ones(len(own), bool)  # the first of a k-mer
        other[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        distinct = other.copy()  # the first of a k-mer and owner
        distinct[1:] |= own[1:] != own[:-1]
        own, first = own[distinct], np.flatnonzero(other[distinct])
        size = np.diff(np.append(first, len(own)))
        shared = size > 1
        if not shared.any():
            return
        own, first, size = own[np.repeat(shared, size)], None, size[shared]
        first = np.cumsum(size) - size
        used = np.unique(own)
        sums = np.zeros((len(names), 2), np.uint64)
        sums[used] = np.array([_spread(names[i]) for i in used.tolist()], np.uint64)
        signs = np.add.reduceat(sums[own], first, axis=0)
        _, chosen, kmers = np.unique(np.column_stack([signs, size.astype(np.uint64)]), axis=0, return_index=True, return_counts=True)
        keys, leasts, members, counts, a, b = [], [], [], [], [], []
        for i, n in zip(chosen.tolist(), kmers.tolist(), strict=True):
            of = [names[j] for j in own[first[i] : first[i] + size[i]].tolist()]
            least = min(of, key=int) if number else min(of)
            x, y = signs[i].view(np.int64).tolist()
            keys += of
            for into, value in ((leasts, least), (members, len(of)), (counts, n), (a, x), (b, y)):
                into += [value] * len(of)
        yield pd.DataFrame({"key": keys, "first": leasts, "members": members, "kmers": counts, "a": a, "b": b})

    cut = stretches(seqs.filter(F.col(key).isNotNull()), key, k)
    found = by_group(cut, "bucket", [], run, "key string, first string, members long, kmers long, a long, b long")
    total = found.groupBy("key", "first", "members", "a", "b").agg(F.sum("kmers").alias("kmers"))
    typed = seqs.schema[key].dataType
    return total.select(F.col("key").cast(typed).alias(key), F.col("first").cast(typed).alias("first"), "members", "kmers")
