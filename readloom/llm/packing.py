"""Best-fit packing of tokenized documents into sequences, planned on the histogram of lengths.

Only counts of lengths (at most `capacity` of them) reach the driver. Best fit decreasing runs over them, moving whole ranges
of sequences with equal room at once; pieces then take planned slots by joining on their rank within their length.
"""

from __future__ import annotations

import bisect
import functools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import bucket_of, filled_id, numbered, restored_id, stash

ROWS_A_BUCKET, MOST_BUCKETS = 2_000, 4_096
#: Chunks, and words, whose ids a Python worker keeps at hand; as many more, older ones, it keeps until the next are full.
CACHE_CHUNKS = 150_000
#: Printable ASCII but the apostrophe, and Latin letters that lower-case to one letter; parts of such chunks.
PLAIN = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
WORDS = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+|[0-9]|[!-/:-@\\[-`{-~]+")
ID_BYTES = 4


class ChunkEncoder:
    """Ids of a text as little-endian unsigned 32-bit numbers, through caches by white-space-free chunk and by word.

    The vocabulary's pre-tokenizer drops white space and never joins across it, so a text's ids are those of its chunks. Its
    normalizer lower-cases, so chunks are mostly told apart without ASCII capitals. It parts chunks at the bounds of letters, single
    digits and marks; a chunk of Latin letters, ASCII digits and marks (no apostrophe, after which some letters part too) is
    parted here, and its words go to the vocabulary's merges at once. All other chunks go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        special = [(t.content, i) for i, t in self._tokenizer.get_added_tokens_decoder().items() if t.special]
        self._mark, self._mark_id = min(special)
        self._special = re.compile("|".join(re.escape(content) for content, _ in special))
        self._merges = self._tokenizer.model.tokenize
        self._letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._known: dict[bytes, bytes] = {}
        self._words: dict[str, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._old_words: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        raw = text.encode("utf-8", "surrogatepass")
        # special tokens are told from others by their case, and a mark of U+0300 to U+036F may combine with one case alone
        chunks = (raw if b"<" in raw or b"\xcc" in raw or b"\xcd" in raw else raw.lower()).split()
        try:
            return b"".join(map(self._known.__getitem__, chunks))
        except KeyError:
            if len(self._known) > CACHE_CHUNKS:
                self._old, self._known = self._known, {}
            missing = [c for c in dict.fromkeys(chunks) if c not in self._known]
        other = []
        for chunk in missing:
            if chunk in self._old:
                self._known[chunk] = self._old[chunk]
                continue
            plain = chunk.decode("utf-8", "replace")
            if PLAIN.fullmatch(plain) and not ("<" in plain and self._special.search(plain)):
                self._known[chunk] = b"".join([self._words.get(w) or self._word(w) for w in WORDS.findall(plain.lower())])
            else:
                other.append(chunk)
        for at in range(0, len(other), 10_000):
            self._learn(other[at : at + 10_000])
        return b"".join(map(self._known.__getitem__, chunks))

    def _word(self, word: str) -> bytes:
        if len(self._words) > CACHE_CHUNKS:
            self._old_words, self._words = self._words, {}
        if ids := self._old_words.get(word):
            self._words[word] = ids
            return ids
        tokens = self._merges(word if word.isascii() else self._letters(word)[0][0])
        ids = self._words[word] = struct.pack(f"<{len(tokens)}I", *(t.id for t in tokens))
        return ids

    def _learn(self, chunks: list[bytes]) -> None:
        texts = [c.decode("utf-8", "replace") for c in chunks]
        if not any(self._mark in t for t in texts):
            ids = np.array(self._tokenizer.encode(self._mark.join(texts), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(ids == self._mark_id).tolist()
            raw = ids.tobytes()
            for c, first, last in zip(chunks, [0, *(e + 1 for e in ends)], [*ends, len(ids)], strict=True):
                self._known[c] = raw[first * ID_BYTES : last * ID_BYTES]
            return
        for c, t in zip(chunks, texts, strict=True):
            self._known[c] = np.array(self._tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@functools.cache
def encoder_of(path: str) -> ChunkEncoder:
    """One for each Python worker: later tasks find the cache filled."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return ChunkEncoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """Columns doc_id (NO_ID for null), piece, start, length, ids_crc32: each document's ids and a final id 0, cut at every `capacity` ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(tokenizer)
        step = capacity * ID_BYTES
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encoder.encode(text or "") + bytes(ID_BYTES)
                for n, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc, n, at // ID_BYTES, len(part) // ID_BYTES, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(filled_id().alias("doc_id"), "text").mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over `counts` of lengths: runs (length, first rank, each, first sequence, offset).

    In a run, sequence `first sequence + k` takes `each` items from offset on: the ranks from `first rank + k * each`.
    Sequences are numbered from 0 without gaps.
    """
    rooms: list[int] = []  # the rooms that open sequences have, in order
    open_at: dict[int, list[tuple[int, int]]] = {}  # ranges (first sequence, how many) by room
    runs, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_at:
                bisect.insort(rooms, room)
                open_at[room] = []
            open_at[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            each = min(left, room // length)  # the tightest sequence stays the tightest until it is full
            if at < len(rooms):
                first, n = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room]
                    rooms.pop(at)
            else:
                first, n = sequences, left // each
                sequences += n
            used = min(n, left // each)
            runs.append((length, rank, each, first, capacity - room))
            put(room - each * length, first, used)
            put(room, first + used, n - used)
            rank, left = rank + used * each, left - used * each
    return runs


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """Columns doc_id, piece, start, length, ids_crc32, sequence_id and offset, a row for each piece of `docs(doc_id, text)`.

    A null or empty text is the single id 0. Only documents over `capacity` ids are cut; their last piece may be shorter.
    Repeated rows are packed each. A very long text is encoded whole. Other columns of `docs` are ignored, whatever their names.
    An empty table gives no rows. `tokenizer` is the path of a public vocabulary file that
    every executor has.
    """
    cut = stash(pieces(docs, tokenizer, capacity))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(counts, capacity)
    first: dict[int, list[tuple[int, int, int, int]]] = {}
    for length, *rest in runs:
        first.setdefault(length, []).append(tuple(rest))
    # a length opens and splits at most three ranges and moves each range once: at most 3 x capacity^2 runs, whatever the corpus;
    # some 3,200 where all 2048 lengths come in random numbers
    lookup = docs.sparkSession.sparkContext.broadcast({k: np.array(v, np.int64).T for k, v in first.items()})
    buckets = max(1, min(MOST_BUCKETS, sum(counts.values()) // ROWS_A_BUCKET))
    ranked = cut.withColumn("_bucket", bucket_of(["doc_id", "piece"], buckets))
    ranked = numbered(ranked, ["length"], "_bucket", ["doc_id", "piece", "ids_crc32"], "_rank").drop("_bucket")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch.pop("_rank").to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length in np.unique(lengths):
                rows = lengths == length
                rank, each, start, from_ = lookup.value[int(length)]
                at = np.searchsorted(rank, ranks[rows], "right") - 1
                past = ranks[rows] - rank[at]
                sequence[rows] = start[at] + past // each[at]
                offset[rows] = from_[at] + past % each[at] * length
            yield batch.assign(sequence_id=sequence, offset=offset)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank").mapInPandas(place, schema)
    return placed.select(restored_id(), *placed.columns[1:])
