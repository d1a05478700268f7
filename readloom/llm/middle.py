"""Fill-in-middle: documents cut into prefix, middle and suffix at line ends, and put together in another order.

A rolling hash cuts texts into chunks where their content says so, so that copied passages give the same chunks wherever they
stand. What a chunk adds (code points, line ends and their places, a sentinel inside) and what its edges show is worked out
once and kept by content; a document's counts are sums over its chunks, and its cuts are found in the chunks that hold them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The strings before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SENTINELS = (PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode())
#: Bytes of a chunk: at least, about on average besides, and at most.
LEAST, MORE, MOST = 256, 1024, 8192
#: Chunks that a worker keeps, in each of two generations; the older one goes when the newer is full.
KEPT = 10_000
#: Bytes of a chunk's edges that a sentinel may cross.
EDGE = max(map(len, _SENTINELS)) - 1
_GEAR = np.random.default_rng(20240611).integers(0, 1 << 32, 256, dtype=np.uint32)


@dataclass(frozen=True, slots=True)
class Summary:
    """What a chunk adds to its document: ends and chars_to are the bytes and code points up to each line end, itself included."""

    chars: int
    ends: np.ndarray
    chars_to: np.ndarray
    sentinel: bool


def chunks(raw: bytes) -> list[bytes]:
    """Chunks whose concatenation is `raw`: one ends where the rolling hash of the 32 bytes before has its upper bits zero.

    The hash is a sum of the bytes' values, each shifted by its age, so 32 bytes decide; it is made for all places at once by
    doubling the width that is summed.
    """
    if len(raw) <= LEAST:
        return [raw] if raw else []
    rolling = _GEAR[np.frombuffer(raw, np.uint8)]
    for width in (1, 2, 4, 8, 16):
        rolling[width:] += rolling[:-width] << np.uint32(width)
    places = (np.flatnonzero(rolling < np.uint32((1 << 32) // MORE)) + 1).tolist()
    out, start = [], 0
    while start < len(raw):
        i = bisect_left(places, start + LEAST)
        end = min(places[i] if i < len(places) else len(raw), start + MOST)
        out.append(raw[start:end])
        start = end
    return out


def summary(chunk: bytes) -> Summary:
    own = np.frombuffer(chunk, np.uint8)
    starts = (own & 0xC0) != 0x80  # of code points; a chunk may begin within one
    ends = np.flatnonzero(own == 10) + 1
    counted = np.cumsum(starts)
    return Summary(int(counted[-1]), ends, counted[ends - 1], any(s in chunk for s in _SENTINELS))


class Memo:
    """Summaries by content: a chunk is looked up by its hash and compared byte by byte, as a dict does, so that none is mistaken."""

    def __init__(self, kept: int = KEPT) -> None:
        self.kept, self.new, self.old, self.hits = kept, {}, {}, 0

    def of(self, chunk: bytes) -> Summary:
        found = self.new.get(chunk)
        if found is None:
            found = self.old.get(chunk)
            self.hits += found is not None
            if len(self.new) >= self.kept:
                self.new, self.old = {}, self.new
            self.new[chunk] = found = found or summary(chunk)
        else:
            self.hits += 1
        return found


@dataclass(frozen=True, slots=True)
class Lined:
    """A document by its chunks: how many lines and code points it has, and where lines end."""

    raw: bytes
    parts: list[Summary]
    lines_to: np.ndarray
    bytes_to: np.ndarray
    chars_to: np.ndarray
    sentinel: bool

    @property
    def lines(self) -> int:
        return int(self.lines_to[-1]) + (bool(self.raw) and self.raw[-1] != 10)

    def cut(self, n: int) -> tuple[int, int]:
        """Bytes and code points of the first `n` lines."""
        if n > self.lines_to[-1]:
            return len(self.raw), int(self.chars_to[-1])
        if n == 0:
            return 0, 0
        at = int(np.searchsorted(self.lines_to, n)) - 1  # the chunk that holds the n-th line end
        i = n - 1 - int(self.lines_to[at])
        return int(self.bytes_to[at]) + int(self.parts[at].ends[i]), int(self.chars_to[at]) + int(self.parts[at].chars_to[i])


def lined(raw: bytes, memo: Memo) -> Lined:
    cut = chunks(raw)
    parts = [memo.of(x) for x in cut]
    sums = lambda values: np.concatenate([[0], np.cumsum(np.fromiter(values, np.int64, len(cut)))])
    crossing = any(s in a[-EDGE:] + b[:EDGE] for a, b in zip(cut, cut[1:], strict=False) for s in _SENTINELS)
    return Lined(raw, parts, sums(len(x.ends) for x in parts), sums(map(len, cut)), sums(x.chars for x in parts), crossing or any(x.sentinel for x in parts))


def _formed(batches: Iterator[pd.DataFrame], per_cent: int, spm_per_cent: int) -> Iterator[pd.DataFrame]:
    memo = Memo()
    for batch in batches:
        rows = []
        for text, h1, h2, h3, h4 in zip(batch["text"], *(batch[f"h{i}"] for i in range(1, 5)), strict=True):
            doc = lined((text or "").encode("utf-8", "surrogatepass"), memo)
            n = doc.lines
            if not n or doc.sentinel or h3 % 100 >= per_cent:
                rows.append((n, "plain", None, None, text or ""))
                continue
            a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
            (first, chars), (second, more) = doc.cut(a), doc.cut(b)
            prefix, middle, suffix = (x.decode("utf-8", "surrogatepass") for x in (doc.raw[:first], doc.raw[first:second], doc.raw[second:]))
            spm = h4 % 100 < spm_per_cent
            out = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}" if spm else f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
            rows.append((n, "spm" if spm else "psm", chars, more - chars, out))
        made = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        made[["prefix_chars", "middle_chars"]] = made[["prefix_chars", "middle_chars"]].astype("Int64")
        yield pd.concat([batch[["doc"]].reset_index(drop=True), made], axis=1)


def fill_in_middle(docs: DataFrame, seed: int = 7, per_cent: int = 100, spm_per_cent: int = 50) -> DataFrame:
    """Columns doc_id, n (lines), form (psm, spm or plain), prefix_chars, middle_chars (code points; null if plain) and output of
    every row of `docs(doc_id, text)`.

    Four numbers, from the SHA-256 of seed and doc_id, decide: two cuts among the n + 1 places between lines, whether the
    document is rearranged (`per_cent` of them are) and whether its suffix comes first (`spm_per_cent`). A document that is
    empty, or holds a sentinel, stays plain. Null texts are empty and plain; rows of one doc_id (a null one counts as an empty
    string) get the same numbers, so equal rows give equal rows. A text of any length is cut whole and takes memory in
    proportion to it, besides a batch and the chunks kept. An empty table gives no rows; other columns are ignored.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}")
    # the id travels as text: a column of longs with nulls would become floats
    wanted = docs.select(F.col("doc_id").cast("string").alias("doc"), "text", *map(number, range(4)))
    schema = "doc string, n long, form string, prefix_chars long, middle_chars long, output string"
    formed = wanted.mapInPandas(lambda batches: _formed(batches, per_cent, spm_per_cent), schema)
    return formed.select(F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that `fill_in_middle` made `output` of: no part holds a sentinel, so each stands once."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    before = lambda x, mark: F.substring_index(x, mark, 1)
    after = lambda x, mark: F.substring_index(x, mark, -1)
    middle, head = after(output, MIDDLE), before(output, MIDDLE)
    psm = F.concat(after(before(head, SUFFIX), PREFIX), middle, after(head, SUFFIX))
    spm = F.concat(after(head, PREFIX), middle, after(before(head, PREFIX), SUFFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
