"""Substring deduplication by sliding sentence spans.

Every run of several consecutive sentences is hashed, equal runs of all documents meet by their hash, and the sentences that any
non-first occurrence of a repeated run covers are removed.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import filled_id

#: A piece ends at a line's end or after closing marks; the white space that follows belongs to it.
PIECE = re.compile(r"[^\n.!?]*(?:\n\s*|[.!?]+\s*|$)")
WORD = re.compile(r"\s*\S+\s*")
ENDS = re.compile(r"[\n.!?]")
#: Rows of documents whose runs are in memory at once.
DOCS = 500
#: A run as a number: 15 bits of hash, its first sentence, how many more it has.
LENGTH_BITS, SENTENCES = 16, (1 << 48) - 1
#: Runs in order of their hash, then of their place.
PLACE = ["hash", "doc_id", "key", "run"]
#: A piece of more than MOST words is cut at the least hash of each WINDOW places between its words.
WINDOW = 9
MOST = 2 * WINDOW - 1
#: Words of a run with the end of a piece inside, and of one within a piece; a shorter one may repeat by chance.
RUN_WORDS, PIECE_WORDS = 16, 17


def sentences(text: str) -> list[str]:
    """Sentences of MOST words at most, whose concatenation is the text.

    Where one ends depends on the words nearby, not on where its line or the text begins. Copies of a stretch agree in an end
    within MOST words from either edge of it, and in all between those two: in a piece that goes on for longer than that, both
    are cut, and alike from WINDOW words inside the stretch. So 51 words (2 * MOST + PIECE_WORDS) hold the same run wherever
    they stand.
    """
    out: list[str] = []
    lead = ""
    for piece in PIECE.findall(text):
        words = WORD.findall(piece)
        if not words:  # white space at the start of the text
            lead += piece
        elif len(words) <= MOST:
            out.append(lead + piece)
            lead = ""
        else:
            ends = [0, *_least_places(words), len(words)]
            whole = [lead + words[0], *words[1:]]
            out += ["".join(whole[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            lead = ""
    return out + [lead] * bool(lead)


def _least_places(words: list[str]) -> list[int]:
    """Places between words whose hash, of the words on both sides, is the first least one of some WINDOW places in a row."""
    import xxhash

    plain = [w.strip().lower() for w in words]
    rank = [xxhash.xxh32_intdigest(f"{a} {b}") for a, b in zip(plain, plain[1:], strict=False)]
    found, least = [], -1
    for start in range(len(rank) - WINDOW + 1):
        last = start + WINDOW - 1
        if least < start:
            least = min(range(start, last + 1), key=rank.__getitem__)
        elif rank[last] < rank[least]:
            least = last
        else:
            continue
        found.append(least + 1)
    return found


def runs_of(text: str) -> list[tuple[int, int, bytes]]:
    """Runs (first, last, normal form) of consecutive sentences: from each sentence on and up to each, the shortest that suffice.

    Both directions, so that a repeated passage is covered to its first and to its last sentence. Sentences without words take
    no part. The normal form is lower case with single spaces.
    """
    at, words, count, ended, begin = [], [], [0], [0], [0]
    for i, sentence in enumerate(sentences(text)):
        if own := sentence.lower().split():
            at.append(i)
            words.append(" ".join(own).encode("utf-8", "surrogatepass"))
            count.append(count[-1] + len(own))
            ended.append(ended[-1] + bool(ENDS.search(sentence.lstrip())))
            begin.append(begin[-1] + len(words[-1]) + 1)
    whole = b" ".join(words)

    def suffices(i: int, j: int) -> bool:
        n = count[j] - count[i]
        return n >= PIECE_WORDS or n >= RUN_WORDS and ended[j - 1] > ended[i]

    n, found, start, end = len(at), set(), 0, 0
    for i in range(n):
        end = max(end, i + 1)
        while end <= n and not suffices(i, end):
            end += 1
        if end > n:
            break
        found.add((i, end))
    for j in range(1, n + 1):
        while start + 1 < j and suffices(start + 1, j):
            start += 1
        if suffices(start, j):
            found.add((start, j))
    return [(at[i], at[j - 1], whole[begin[i] : begin[j] - 1]) for i, j in sorted(found)]


def hashed_runs(docs: DataFrame) -> DataFrame:
    """A row for each run of `docs(doc_id, text, key)`: hash, doc_id, key and run, its sentences with 15 more bits of hash.

    A repeated row counts once in DOCS rows. A run that also stands at an earlier place of the same DOCS rows has a negative
    `run` and a hash of its document, so that of a run that most texts have, one in DOCS goes to the hash's task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            for at in range(0, len(batch), DOCS):
                part = batch.iloc[at : at + DOCS]
                rows, first, more, raw = array("q"), array("q"), array("q"), bytearray()
                for n, text in enumerate(part["text"]):
                    for a, b, run_ in runs_of(text) if text else ():
                        rows.append(n)
                        first.append(a)
                        more.append(b - a)
                        raw += xxhash.xxh3_128_digest(run_)
                if rows:
                    h = np.frombuffer(raw, "<i8").reshape(-1, 2)
                    span = (h[:, 1] & 0x7FFF) << 48 | np.asarray(first) << LENGTH_BITS | np.asarray(more)
                    yield sent(part["doc_id"].to_numpy()[np.asarray(rows)], part["key"].to_numpy()[np.asarray(rows)], h[:, 0], span)

    def sent(doc_id: np.ndarray, key: np.ndarray, hashes: np.ndarray, span: np.ndarray) -> pd.DataFrame:
        order = np.lexsort((span, key, doc_id, hashes))
        out = pd.DataFrame({"hash": hashes[order], "doc_id": doc_id[order], "key": key[order], "run": span[order]})
        new = np.ones(len(out), bool)
        new[1:] = (out.to_numpy()[1:] != out.to_numpy()[:-1]).any(axis=1)
        out = out[new].reset_index(drop=True)
        again = _first_of(out) != np.arange(len(out))
        other = out["key"] ^ out["doc_id"] * 0x9E3779B97F4A7C1
        return out.assign(hash=np.where(again, other, out["hash"]), run=np.where(again, -1 - (out["run"] & SENTENCES), out["run"]))

    return docs.mapInPandas(run, "hash long, doc_id long, key long, run long")


def _first_of(runs: pd.DataFrame) -> np.ndarray:
    """For each row, the number of the first row with its whole hash; equal 64-bit hashes lie together."""
    h, more = runs["hash"].to_numpy(), runs["run"].to_numpy() >> 48
    new = np.ones(len(runs), bool)
    new[1:] = (h[1:] != h[:-1]) | (more[1:] != more[:-1])
    return np.maximum.accumulate(np.where(new, np.arange(len(runs)), 0))


def repeats(runs: DataFrame) -> DataFrame:
    """Of `hashed_runs`, doc_id, key, first and last of those that aren't at the first place (doc_id, key, first) of their hash.

    One shuffle brings equal hashes together in order of place; a task streams through them and holds one row back.
    """

    def told(rows: pd.DataFrame, span: np.ndarray) -> pd.DataFrame:
        first = span >> LENGTH_BITS
        return pd.DataFrame({"doc_id": rows["doc_id"], "key": rows["key"], "first": first, "last": first + (span & (1 << LENGTH_BITS) - 1)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the first row of the last hash
        for batch in batches:
            again = batch["run"].to_numpy() < 0
            yield told(batch[again], -1 - batch["run"].to_numpy()[again])
            own = pd.concat([held, batch[~again]], ignore_index=True)
            if len(own):
                first = _first_of(own)
                span = own["run"].to_numpy()
                place = np.column_stack([own["doc_id"], own["key"], span >> LENGTH_BITS])
                later = (place != place[first]).any(axis=1)
                yield told(own[later], span[later] & SENTENCES)
                held = own.iloc[first[-1:]]

    return runs.repartition("hash").sortWithinPartitions(*PLACE).mapInPandas(run, "doc_id long, key long, first long, last long")


def _cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for text, own in zip(texts, spans, strict=True):
        if text is None or own is None:
            out.append((None, None, None))
            continue
        whole = sentences(text)
        gone = {k for x in own for k in range(x["first"], x["last"] + 1)}
        out.append(("".join(s for k, s in enumerate(whole) if k not in gone), len(whole), len(gone)))
    frame = pd.DataFrame(out, columns=["text", "sentences", "removed"])
    return frame.astype({"sentences": "Int32", "removed": "Int32"})


def dedup_spans(docs: DataFrame) -> DataFrame:
    """`docs` with text cut, and a column removed_sentences (0 where the text is as it was).

    The first occurrence of a run, by doc_id (nulls first) and then place, stays; so does all of a text without repeated runs,
    byte for byte. A later copy of a whole text of RUN_WORDS words or more (or PIECE_WORDS without an end of a sentence between)
    loses all its sentences and has text ''; shorter texts have no run and stay, copies too. A run repeated within one text goes
    there too. Null and empty texts have no runs. Rows that repeat both doc_id and text are one document and are treated
    alike. A text of any length is cut whole; its sentences and runs are in memory at once. A column of `docs` that is named like a
    result is replaced. An empty table gives no rows.
    """
    docs = docs.drop("removed_sentences")
    key = F.xxhash64("text")
    later = repeats(hashed_runs(docs.select(filled_id().alias("doc_id"), "text", key.alias("key"))))
    gone = later.groupBy("doc_id", "key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    held = docs.select(F.struct(*docs.columns).alias("doc"), filled_id().alias("id"), key.alias("key"))  # in a struct, no column's name can clash
    joined = held.join(gone, (held["id"] == gone["doc_id"]) & (held["key"] == gone["key"]), "left")
    cut_of = F.pandas_udf(_cut, "struct<text string, sentences int, removed int>")
    text = F.when(F.col("spans").isNull(), F.col("doc.text")).otherwise(F.col("cut.text"))
    cut = joined.withColumn("cut", cut_of(F.when(F.col("spans").isNotNull(), F.col("doc.text")), "spans"))
    columns = [text.alias(c) if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns]
    return cut.select(*columns, F.coalesce("cut.removed", F.lit(0)).alias("removed_sentences"))
