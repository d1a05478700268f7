"""SimHash near-duplicates: fingerprints of word shingles, compared bit plane by bit plane.

Fingerprints that may lie within the radius meet in blocks. In a block, bit planes are stored vertically (one machine word
holds the same bit of 64 fingerprints), distances grow in carry-save counters made of words too, and a block is abandoned as
soon as every lane is beyond the radius.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm import near
from readloom.llm.common import filled_id, stash
from readloom.llm.components import components

BITS = 64
#: Rows of (query, machine word) that are compared at once, and lanes within the radius that are handed on at once: they bound
#: a task's memory whatever a block holds.
COMPARE_ROWS, HITS = 1 << 17, 1 << 18


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `width` words; of the whole sequence if it is shorter; none for no words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    of, join = xxhash.xxh64_intdigest, b" ".join
    return np.fromiter((of(join(x), 42) for x in zip(*(words[i:] for i in range(width)), strict=False)), np.uint64, len(words) - width + 1)


def fingerprint_of(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, as a signed 64-bit number; 0 for none."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a long text takes no more memory than 65536 shingles
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: Column | str, width: int) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(shingle_hashes(x, width)) for x in texts], dtype="int64")

    return of(text)


def hex_of(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_lanes(prints: np.ndarray, sizes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (later, earlier, distance) of rows of one block within the radius; blocks lie one after another, `sizes` long.

    The lanes of a block are its rows, 64 to a word; each row is a query against the words of its block up to its own.
    """
    prints = prints.view(np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    block = np.repeat(np.arange(len(sizes)), sizes)
    lane = np.arange(len(prints)) - starts[block]
    words = (sizes + 63) // 64
    first_word = np.concatenate([[0], np.cumsum(words)[:-1]])
    word_of = first_word[block] + lane // 64
    edges = np.flatnonzero(np.diff(word_of, prepend=-1))
    planes = np.empty((BITS, int(words.sum())), np.uint64)
    for b in range(BITS):
        planes[b] = np.bitwise_or.reduceat(((prints >> np.uint64(b)) & np.uint64(1)) << (lane % 64).astype(np.uint64), edges)
    queries_of = lane // 64 + 1  # words with an earlier lane, the query's own included
    ends = np.cumsum(queries_of)
    counters = max(1, int(radius).bit_length())
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    done = 0
    while done < len(prints):
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + COMPARE_ROWS, "right")))
        n = queries_of[done:upto]
        query = np.repeat(np.arange(done, upto), n)
        word = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first_word[block[done:upto]], n)
        earlier = np.where(word == word_of[query], (np.uint64(1) << (lane[query] % 64).astype(np.uint64)) - np.uint64(1), full)
        over, counts = ~earlier, [np.zeros(len(query), np.uint64) for _ in range(counters)]
        alive = np.arange(len(query))
        for b in range(BITS):
            carry = planes[b][word] ^ np.where((prints[query] >> np.uint64(b)) & np.uint64(1), full, np.uint64(0))
            for k in range(counters):
                counts[k], carry = counts[k] ^ carry, counts[k] & carry
            over |= carry
            if b % 8 == 7:  # lanes beyond the radius stay so; rows with no other lanes are abandoned
                over |= _above(counts, radius)
                keep = over != full
                if not keep.all():
                    query, word, over, alive = query[keep], word[keep], over[keep], alive[keep]
                    counts = [c[keep] for c in counts]
                if not len(query):
                    break
        for part in _portions(over):
            hit = np.unpackbits((~over[part]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
            row, bit = np.nonzero(hit)
            row += part.start
            distance = sum(((counts[k][row] >> bit.astype(np.uint64)) & np.uint64(1)).astype(np.int64) << k for k in range(counters))
            earlier_row = starts[block[query[row]]] + (word[row] - first_word[block[query[row]]]) * 64 + bit
            yield query[row], earlier_row, distance
        done = upto


def _above(counts: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter exceeds the radius, by comparing bits from the highest."""
    above, equal = np.zeros_like(counts[0]), ~np.zeros_like(counts[0])
    for k in reversed(range(len(counts))):
        if radius >> k & 1:
            equal &= counts[k]
        else:
            above |= equal & counts[k]
            equal &= ~counts[k]
    return above


def _portions(over: np.ndarray) -> Iterator[slice]:
    """Stretches of rows with about HITS lanes within the radius."""
    ends = np.cumsum(np.bitwise_count(~over), dtype=np.int64)
    at = 0
    while at < len(over):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HITS, "right")))
        yield slice(at, upto)
        at = upto


def _sizes(cells: pd.DataFrame) -> np.ndarray:
    """How many rows each cell has; its rows lie together."""
    cell = cells["cell"].to_numpy()
    return np.diff(np.append(np.flatnonzero(np.diff(cell, prepend=~cell[:1])), len(cell)))


def by_cell(rows: DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """`run` over `rows(cell, node, ...)`, some whole cells at once with their rows in order of node: a task holds one batch and one cell."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            cell = batch["cell"].to_numpy()
            if not len(cell):
                continue
            upto = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            if held and (upto or held[-1]["cell"].iat[-1] != cell[0]):
                yield run(pd.concat([*held, batch[:upto]], ignore_index=True))
                held = []
            elif upto:
                yield run(batch[:upto].reset_index(drop=True))
            held.append(batch[upto:])
        if held:
            yield run(pd.concat(held, ignore_index=True))

    return rows.repartition("cell").sortWithinPartitions("cell", "node").mapInPandas(stream, schema)


def links_in_blocks(blocks: DataFrame, radius: int) -> DataFrame:
    """Links (src, dst) between rows of `blocks(cell, fp, node)` of one cell within the radius.

    One link a row at most, to the first row of its component in the cell: no connection is lost, and no group gives all its pairs.
    """

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        label = np.arange(len(cells))
        for later, earlier, _ in near_lanes(cells["fp"].to_numpy(), _sizes(cells), radius):
            _unite(label, later, earlier)
        rows = np.flatnonzero(label != np.arange(len(cells)))
        node = cells["node"].to_numpy()
        return pd.DataFrame({"src": node[rows], "dst": node[label[rows]]})

    return by_cell(blocks, run, "src long, dst long")


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Bring the rows a and b, pair by pair, under one label, the smallest row of their component, by repeated halving of ways."""
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def pigeonhole_blocks(prints: DataFrame, radius: int, split_over: int = 512) -> DataFrame:
    """Rows (cell, fp, node) of cells that hold together any two fingerprints of `prints(fp, node)` that differ in at most `radius` bits.

    The 64 bits fall into radius + 2 parts; two such fingerprints agree in at least two of them, so each pair of parts is a
    key. A key with over `split_over` fingerprints is keyed anew on pairs of parts of its other bits, by the same argument, so
    that a cell never holds more than the 2^(bits left) values that distinct fingerprints leave.
    """
    bits = list(range(BITS))
    top = _keyed(prints, bits, radius, "key")
    counted = stash(top.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    top = stash(top.join(counted, "key"))
    small = top.filter(F.col("n") <= split_over).select(F.xxhash64("key").alias("cell"), "fp", "node")
    for i, (_, rest) in enumerate(_pairs(bits, radius)):
        own = top.filter((F.col("n") > split_over) & (F.col("key.part") == i)).select("fp", "node", F.col("key").alias("_top"))
        small = small.unionByName(_keyed(own, rest, radius, "_low").select(F.xxhash64("_top", "_low").alias("cell"), "fp", "node"))
    return small


def _pairs(bits: list[int], radius: int) -> list[tuple[list[int], list[int]]]:
    parts = [x.tolist() for x in np.array_split(np.array(bits), radius + 2)]
    return [(sorted(a + b), sorted(set(bits) - set(a) - set(b))) for a, b in combinations(parts, 2)]


def _keyed(prints: DataFrame, bits: list[int], radius: int, name: str) -> DataFrame:
    keys = []
    for i, (own, _) in enumerate(_pairs(bits, radius)):
        mask = sum(1 << b for b in own)
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(mask)).alias("value")))
    return prints.select("*", F.explode(F.array(*keys)).alias(name))


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """Columns doc_id, fingerprint (16 hex digits) and component_id of every row of `docs(doc_id, text)`.

    Null and empty texts have fingerprint zero and link like others. Rows that share a doc_id (repeats) each get their row.
    Distinct fingerprints are the nodes that are compared and joined, so a group of copies of any size is one node, and a
    document without doc_id links like any other; component_id is the smallest doc_id of the component, null if none of its
    documents has one. A very long text is read whole, its hashes in portions. An empty table gives no rows; other columns of
    `docs` are ignored.
    """
    prints = stash(docs.select("doc_id", fingerprint("text", width).alias("fp")))
    least = stash(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    nodes = least.select("fp", F.col("fp").alias("node"))
    joined = components(links_in_blocks(pigeonhole_blocks(nodes, radius), radius))
    of_print = stash(least.join(joined, least["fp"] == joined["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component")))
    smallest = stash(of_print.groupBy("component").agg(F.min("least").alias("component_id")))
    named = of_print.join(smallest, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")


#: Five min-hashes a band and 25 bands: texts of similarity 0.8 share no band in 5 of 100,000 cases.
BANDS, ROWS_A_BAND = 25, 5
#: Fingerprints of texts of similarity 0.8 differ in about 10 bits over many shingles, in about 12 over four and five; in more
#: than this in one pair of 100,000 at most.
WIDE_RADIUS = 26
#: One byte of each of so many min-hashes is a text's sketch. Texts of similarity 0.8 agree in 102 on average; fewer than
#: ALIKE, five deviations below, in two pairs of a million. Most candidates at 0.5 and less fail, so their shingles aren't read.
SKETCH, ALIKE = 128, 0.625
_FACTORS = np.random.default_rng(20240501).integers(0, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signature(texts: pd.Series, width: int) -> pd.DataFrame:
    rows = []
    for text in texts:
        h = np.unique(shingle_hashes(text, width))
        if not len(h):
            rows.append((0, 0, bytes(SKETCH), [0] * BANDS))
            continue
        least = np.full(SKETCH, np.iinfo(np.uint64).max)
        for at in range(0, len(h), 512):
            least = np.minimum(least, (h[at : at + 512, None] * _FACTORS).min(axis=0))
        keys = np.arange(1, BANDS + 1, dtype=np.uint64)
        for own in least[: BANDS * ROWS_A_BAND].reshape(BANDS, ROWS_A_BAND).T:
            keys = (keys ^ own) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
        rows.append((fingerprint_of(h), len(h), least.astype(np.uint8).tobytes(), keys.view(np.int64).tolist()))
    return pd.DataFrame(rows, columns=["fp", "shingles", "sketch", "keys"])


def _shingle_set(texts: pd.Series, width: int) -> pd.Series:
    return pd.Series([np.unique(shingle_hashes(x, width)).tobytes() for x in texts])


def wide_pairs(cells: pd.DataFrame) -> near.Pairs:
    """(later, earlier) of rows of each cell whose fingerprints are within WIDE_RADIUS."""
    for later, earlier, _ in near_lanes(cells["fp"].to_numpy(), _sizes(cells), WIDE_RADIUS):
        yield later, earlier


def one_of_each_group(docs: DataFrame, width: int = 5, similarity: float = 0.8, crowded_over: int = near.CROWDED) -> DataFrame:
    """`docs(doc_id, text, ...)` with one row of each group of near copies: that of the smallest doc_id, then of the least text hash.

    Near copies are texts whose sets of `width`-word shingles have a Jaccard similarity of `similarity` or more, and whatever is
    linked through such. At 0.8, fingerprints differ in too many bits for keys on their parts to tell much, so blocks come from
    bands of min-hashes of the shingles; in a block fingerprints are compared bit-sliced, then sketches, then whole sets of
    shingles, and these decide.

    See `near` for how blocks are gone through: none is capped, however large, and no pair of a block is left out.

    Equal texts are one. Null and empty texts are equal and without words, a group of their own. Different texts under one
    doc_id (a null one too) are different documents; of rows that repeat both, the least by hash stays. Columns may have any
    names. An empty table gives no rows.
    """
    sign = F.pandas_udf(lambda s: _signature(s, width), "struct<fp long, shingles long, sketch binary, keys array<long>>")
    text = F.coalesce("text", F.lit(""))
    signed = docs.select(filled_id().alias("id"), F.md5(text).alias("same"), sign(text).alias("s"))
    texts = signed.groupBy("same").agg(F.min("id").alias("id"), F.first("s").alias("s"))
    nodes = stash(texts.select(F.monotonically_increasing_id().alias("node"), "id", "same", "s.fp", "s.shingles", "s.sketch", "s.keys"))
    signs = nodes.select("node", "fp", "shingles", "sketch")
    dealt = near.sharing_keys(nodes.filter("shingles > 0").select("node", "shingles", F.explode("keys").alias("key")))

    wanted = nodes.select("node", "id", "same").join(dealt.select("node").distinct(), "node")
    whole = docs.select(filled_id().alias("id"), F.md5(text).alias("same"), text.alias("whole")).join(wanted, ["id", "same"]).groupBy("id", "same", "node").agg(F.first("whole").alias("whole"))
    shingle_set = F.pandas_udf(lambda s: _shingle_set(s, width), "binary")
    sets = stash(whole.select("node", shingle_set("whole").alias("shingle_set")))

    rule = near.Rule(round(100 * similarity), ALIKE * SKETCH, wide_pairs)
    labels = near.labels(dealt, signs, sets, rule, crowded_over)
    first = nodes.select("node", "id", "same").join(labels, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(F.min(F.struct("id", "same")).alias("first"))
    held = docs.select(F.struct(*docs.columns).alias("doc"), filled_id().alias("id"), F.md5(text).alias("same"))
    staying = held.join(first.select("first.id", "first.same"), ["id", "same"], "left_semi")
    return staying.groupBy("id", "same").agg(F.min_by("doc", F.xxhash64(F.to_json("doc"))).alias("doc")).select("doc.*")
