"""MinHash near-duplicates by fast similarity sketches.

A sketch has COORDINATES places. In a round every shingle of a text is hashed to one place and a value, and a place keeps the
least; rounds follow one another, each with larger values, until every place is filled. After as many rounds as places, round
after round goes to one place each, so that all are filled at last, however few shingles there are. Two sketches agree in a
place with a probability of their texts' similarity, as with one hash function a place, but a text of many shingles needs one
round or few; and the places share their hashes as a sample without replacement would, so agreement is as concentrated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm import near
from readloom.llm.common import filled_id, restored_id, stash

#: Places a band and bands: texts of similarity 0.85 share no band in 4 of 10 million cases.
ROWS_A_BAND, BANDS = 5, 25
COORDINATES = ROWS_A_BAND * BANDS
#: So many standard deviations below their mean, near texts agree in fewer bytes of their sketches, one a place, in fewer than one pair of a million.
DEVIATIONS = 5
#: Shingles that are hashed at once, and hashes a place of the rounds that are made together: about as many as fill all places.
AT_ONCE, AT_A_TIME = 1 << 14, 8
#: Texts whose shingles are in memory at once.
TEXTS = 500
#: The rounds' numbers stand above so many bits of a value.
VALUE_BITS = 48


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finisher of SplitMix64: every bit of x moves every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ROUND = _mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted different 64-bit hashes of each run of `width` words, A-Z in lower case; of the whole sequence if it is shorter; none
    for no words. A run's hash is made of its words' hashes in turn, so that each word is hashed once."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    of = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    runs, width = max(1, len(words) - width + 1), min(width, len(words))
    made = np.zeros(runs if width else 0, np.uint64)
    for i in range(width):
        made = _mixed(made * np.uint64(3) + of[i : i + runs])
    made.sort()
    return made[np.concatenate([[True], made[1:] != made[:-1]])] if width else made


def sketch(shingles: np.ndarray, places: int = COORDINATES) -> np.ndarray:
    """The least value of each place over the rounds needed; `shingles` are different 64-bit hashes, one at least."""
    least, most = np.full(places, np.iinfo(np.uint64).max), np.iinfo(np.uint64).max
    step = -(-AT_A_TIME * places // len(shingles))
    for done in range(0, places, step):
        turn = np.arange(done, min(places, done + step), dtype=np.uint64)[:, None]
        for at in range(0, len(shingles), AT_ONCE):  # a long text takes no more memory than AT_ONCE shingles
            h = _mixed(shingles[None, at : at + AT_ONCE] ^ _ROUND[done : done + len(turn), None])
            place = (h & np.uint64(0xFFFFFFFF)) * np.uint64(places) >> np.uint64(32)
            np.minimum.at(least, place.astype(np.int64).ravel(), ((turn << np.uint64(VALUE_BITS)) | (h >> np.uint64(64 - VALUE_BITS))).ravel())
        if least.max() < most:  # later rounds have larger values
            return least
    for place in np.flatnonzero(least == most):  # the rounds that go to one place each
        h = _mixed(shingles ^ _ROUND[places + place]).min() >> np.uint64(64 - VALUE_BITS)
        least[place] = (np.uint64(places + place) << np.uint64(VALUE_BITS)) | h
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """BANDS keys of each row of sketches."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(least), BANDS))
    for i in range(ROWS_A_BAND):
        keys = _mixed(keys ^ least.reshape(-1, BANDS, ROWS_A_BAND)[:, :, i])
    return keys.view(np.int64)


def least_agreement(per_cent: int) -> float:
    """86 of 125 bytes at similarity 0.85, where the mean is 106."""
    p = per_cent / 100
    return COORDINATES * p - DEVIATIONS * (COORDINATES * p * (1 - p)) ** 0.5


def _signature(texts: pd.Series, width: int) -> pd.DataFrame:
    """Of each text: how many different shingles, a 128-bit hash of their set, the sketch's lowest bytes, and band keys."""
    import xxhash

    sets = [shingle_set(text, width) for text in texts]
    least = np.array([sketch(h) if len(h) else np.zeros(COORDINATES, np.uint64) for h in sets], np.uint64).reshape(-1, COORDINATES)
    low, keys = _mixed(least).astype(np.uint8), band_keys(least)
    rows = [(len(h), xxhash.xxh3_128_digest(h.tobytes()), low[i].tobytes(), keys[i]) if len(h) else (0, b"", b"", []) for i, h in enumerate(sets)]
    return pd.DataFrame(rows, columns=["shingles", "same", "sketch", "keys"])


def _signatures(batches: Iterator[pd.Series], width: int) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.concat([_signature(texts[at : at + TEXTS], width) for at in range(0, len(texts), TEXTS)] or [_signature(texts, width)], ignore_index=True)


def near_duplicates(docs: DataFrame, width: int = 5, per_cent: int = 85, crowded_over: int = near.CROWDED) -> DataFrame:
    """Columns doc_id, n_shingles, component_id, kept of every row of `docs(doc_id, text)`.

    Texts are linked whose sets of `width`-word shingles have 100 * common >= `per_cent` * all. Candidates share one of BANDS bands of
    their sketches; whole sets (of the shingles' 64-bit hashes) decide. Texts of one set are one node, so a group of copies of any
    size is compared once; see `near` for how large blocks are compared without their pairs as rows.

    component_id is the smallest doc_id reachable, and the row's own for texts without words (null and empty ones too), which are
    linked with nothing. Rows without doc_id link others but name no component: where no doc_id is reachable it is null. kept says
    whether the two are equal, nulls too, so repeated rows of one doc_id are kept alike. A text of any length is read whole;
    memory grows with it. An empty table gives no rows; other columns of `docs` are ignored.
    """

    @F.pandas_udf("struct<shingles long, same binary, sketch binary, keys array<long>>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _signatures(batches, width)

    @F.pandas_udf("binary")
    def whole(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(x, width).tobytes() for x in texts])

    signed = stash(docs.select(filled_id().alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("copy"), sign("text").alias("s")).select("id", "copy", "s.*"))
    sets_ = signed.filter("shingles > 0").groupBy("same").agg(F.min(restored_id("id")).alias("least"), F.min(F.struct("id", "copy")).alias("one"), F.first(F.struct("shingles", "sketch", "keys")).alias("s"))
    nodes = stash(sets_.select(F.monotonically_increasing_id().alias("node"), "same", "least", "one.id", "one.copy", "s.*"))

    dealt = near.sharing_keys(nodes.select("node", "shingles", F.explode("keys").alias("key")))
    wanted = nodes.select("node", "id", "copy").join(dealt.select("node").distinct(), "node")
    texts = docs.select(filled_id().alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("copy"), "text").join(wanted, ["id", "copy"])
    sets = stash(texts.groupBy("id", "copy", "node").agg(F.first("text").alias("text")).select("node", whole("text").alias("shingle_set")))
    rule = near.Rule(per_cent, least_agreement(per_cent))
    labels = near.labels(dealt, nodes.select("node", "shingles", "sketch"), sets, rule, crowded_over)

    placed = stash(nodes.select("node", "same", "least").join(labels, "node", "left").select("same", "least", F.coalesce("component", "node").alias("component")))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stash(placed.join(smallest, "component").select("same", "component_id"))
    rows = signed.select(restored_id("id"), "same", F.col("shingles").alias("n_shingles"))
    linked = rows.filter("n_shingles > 0").join(named, "same").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
