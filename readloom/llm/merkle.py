"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections, in native expressions.

A sentence's node is a hash of its text, that of a paragraph (a line) a hash of its sentences' nodes, that of a section a hash of
its paragraphs' nodes with theirs below, all 64 bits of MD5. Sections end after a paragraph whose hash ends in 0, 1, 2 or 3, so an
edit moves no section bound elsewhere. These short nodes are only compared within two trees, from the top, where branches that differ
are opened: they tell how much is alike and where the first edit is. The root, the fingerprint, stands on nodes of full width: a
paragraph's SHA-256, a section's over its paragraphs', the root's over its sections', so roots are equal where texts are.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.bind import bind

#: Rows of a stretch of ascending doc_ids, and the most stretches: a window's task holds one stretch at a time.
ROWS_A_STRETCH, MOST_STRETCHES = 500, 65_536
#: A node is written as its hash, a mark, and its children: paragraph `hash:sentence,sentence`, section `hash|paragraph;paragraph`.
HASH = 16


def _node(content: Column) -> Column:
    return F.substring(F.md5(content), 1, HASH)


def _children(node: Column, mark: str) -> Column:
    return F.split(F.substr(node, F.lit(HASH + 2)), mark)


def tree(text: Column) -> Column:
    """struct<root, sections, sentences (how many different ones)> of a text; an empty text has one empty paragraph."""
    below = F.transform(F.split(text, "\n"), lambda p: F.array_join(F.transform(F.split(p, r"(?<=[.!?|]\s?)(?=[^\s.!?|])"), _node), ","))

    def ended(parts: Column, paragraphs: Column) -> Column:
        """Of each section, its `parts` (one a paragraph) joined."""
        marked = F.zip_with(parts, paragraphs, lambda x, p: F.concat(x, F.when(F.substring(p, HASH, 1).isin(*"0123"), "/").otherwise(";")))
        return bind(F.array_join(marked, ""), lambda j: F.split(F.substring(j, F.lit(1), F.length(j) - 1), "/"))

    def whole(children: Column) -> Column:
        count = F.size(F.array_distinct(F.split(F.array_join(children, ","), ",")))
        paragraphs = F.transform(children, lambda c: F.concat(_node(c), F.lit(":"), c))
        own = lambda p: F.struct(root_of(ended(F.transform(F.split(text, "\n"), _full), p)).alias("root"), F.transform(ended(p, p), lambda b: F.concat(_node(b), F.lit("|"), b)).alias("sections"), count.alias("sentences"))
        return bind(paragraphs, own)

    return bind(below, whole)


def _full(content: Column) -> Column:
    return F.sha2(content, 256)


def root_of(sections: Column) -> Column:
    """Of the joined full hashes of each section's paragraphs."""
    return _full(F.array_join(F.transform(sections, _full), ","))


def _apart(a: Column, b: Column, use) -> Column:
    """`use` of what either side has and the other hasn't, as x.a and x.b."""
    return bind(F.struct(F.array_except(a, b).alias("a"), F.array_except(b, a).alias("b")), use)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the share of both trees' different sentences that no differing branch holds alone.

    Sections that both trees have stay closed, and so do the paragraphs that both have in other sections.
    """

    def opened(x: Column, mark: str) -> tuple[Column, Column]:
        return tuple(F.flatten(F.transform(side, lambda node: _children(node, mark))) for side in (x["a"], x["b"]))

    alone = _apart(a["sections"], b["sections"], lambda s: _apart(*opened(s, ";"), lambda p: _apart(*opened(p, ","), lambda x: F.size(x["a"]) + F.size(x["b"]))))
    return F.when(a["root"] == b["root"], 1.0).otherwise(1.0 - alone / (a["sentences"] + b["sentences"]))


def first_difference(a: Column, b: Column) -> Column:
    """Number from 0 of the first paragraph that differs, found in the first section that does; null for equal trees."""

    def place(x: Column, y: Column) -> Column:
        return F.array_position(F.zip_with(x, y, lambda i, j: i.eqNullSafe(j)), F.lit(False)).cast("int") - 1

    def within(k: Column) -> Column:
        before = F.aggregate(F.slice(a["sections"], F.lit(1), k), F.lit(0), lambda n, s: n + F.size(F.split(s, ";")))
        none = F.array().cast("array<string>")
        return before + place(*(F.coalesce(_children(F.get(t["sections"], k), ";"), none) for t in (a, b)))

    return F.when(a["root"] != b["root"], bind(place(a["sections"], b["sections"]), within))


def _stretched(docs: DataFrame) -> DataFrame:
    """`docs(doc_id, text)` with h, a hash of the text that orders equal ids, and stretch, which grows with (doc_id, h), nulls first.

    Bounds are quantiles of doc_id; a JVM-side search finds a row's. Rows without doc_id are dealt by h.
    """
    counted = docs.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("ids")).first()
    stretches = lambda n: max(1, min(MOST_STRETCHES, n // ROWS_A_STRETCH))
    n, parts = stretches(counted["ids"]), stretches(counted["n"] - counted["ids"])
    cuts = [i / n for i in range(1, n)]
    bounds = sorted({float(b) for b in docs.agg(F.percentile_approx("doc_id", cuts, 20 * n)).first()[0] or []}) if cuts else []
    hashed = docs.withColumns({"h": F.xxhash64("text"), "_id": F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))})
    if bounds:
        hashed = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol="_id", outputCol="_stretch").transform(hashed)
    else:
        hashed = hashed.withColumn("_stretch", F.lit(0))
    by_hash = F.floor((F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 11) / float(1 << 53)) * parts) - parts
    stretch = F.when(F.col("doc_id").isNull(), by_hash).otherwise(F.col("_stretch")).cast("int")
    return hashed.withColumn("stretch", stretch).drop("_id", "_stretch")


def with_next(docs: DataFrame, made: Column) -> DataFrame:
    """`docs(doc_id, text)` with own, the value of `made(text)`, and the next row's text and value, next_text and next_own, by doc_id,
    nulls first; the first row's after the last.

    A stretch of rows is a window of its own; its last row takes the first row of the next one, from a small table of these.
    Texts are shuffled once, and `made` is computed once a row.
    """
    placed = _stretched(docs)
    firsts = placed.groupBy("stretch").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "h")).alias("f")).select("stretch", "f.doc_id", "f.h").collect()
    known = sorted(firsts, key=lambda r: r["stretch"])
    after = [(r["stretch"], known[(i + 1) % len(known)]["doc_id"], known[(i + 1) % len(known)]["h"]) for i, r in enumerate(known)]
    heads = docs.sparkSession.createDataFrame(after, "of int, head long, head_h long")  # a row a stretch, MOST_STRETCHES twice at most
    order = Window.partitionBy("stretch").orderBy(F.col("doc_id").asc_nulls_first(), "h")
    own = placed.repartition("stretch").withColumn("own", made)  # made behind the shuffle, which the window then needs no more
    led = own.withColumns({"_text": F.lead("text").over(order), "_own": F.lead("own").over(order), "_last": F.lead(F.lit(1)).over(order).isNull()})
    found = placed.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("h") == F.col("head_h"))).groupBy("of").agg(F.first("text").alias("text"))
    first = found.withColumn("own", made).select("of", F.col("text").alias("_first_text"), F.col("own").alias("_first_own"))
    joined = led.join(first, (F.col("stretch") == F.col("of")) & F.col("_last"), "left")
    following = lambda c: F.when(F.col("_last"), F.col(f"_first_{c}")).otherwise(F.col(f"_{c}"))
    return joined.select("doc_id", "text", "own", following("text").alias("next_text"), following("own").alias("next_own"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_sections, n_paragraphs,
    first_edit of every row of `docs(doc_id, text)`; its other columns are ignored, whatever their names.

    The edited text ends, for its last half of code points (rounded down), in the first as many of the next document; the last
    document is followed by the first, and one alone by itself. Rows that repeat a doc_id, and rows without one, are ordered by a
    hash of their texts. A null text is empty; empty texts have the fingerprint of one empty paragraph. first_edit is the first
    paragraph in which the edited text differs, null where it doesn't. The tree of a very long text takes about a third of its size.
    An empty table gives no rows.
    """
    filled = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    texts = with_next(filled, tree(F.col("text"))).withColumn("edited", edited)
    trees = texts.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.size(F.split("text", "\n")).alias("n_paragraphs"), F.col("own").alias("t"), tree(F.col("edited")).alias("e"), F.col("next_own").alias("n"))
    t, e = F.col("t"), F.col("e")
    return trees.select(
        "doc_id", "n_chars", "edited_sha256",
        t["root"].alias("fingerprint"), e["root"].alias("edited_fingerprint"),
        likeness(t, e).alias("near_edited"), likeness(t, F.col("n")).alias("near_next"),
        F.size(t["sections"]).alias("n_sections"), "n_paragraphs", first_difference(t, e).alias("first_edit"),
    )
