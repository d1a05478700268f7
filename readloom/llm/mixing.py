"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted target / size times: whole copies, and a fraction of one. Fractions are rounded in pairs:
mass (words) moves from one document of a pair to the other, at random but fair, until one of them is whole; the other goes on.
Buckets of documents are folded this way first, then what each bucket leaves, level by level: a reduction tree in which every
step is a group of bounded size. A source's words stay exact up to the single document that is left at its root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.common import WORD, bucket_of, numbered, stash

#: Documents that a node of the tree folds, on average.
FAN_IN = 64
#: A fraction this near to 0 or 1 is whole.
NEAR = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0) -> DataFrame:
    """Columns source, source_size, rows, target from `sizes(source, size)`.

    Sources in order of their code points, null last, weigh as `weights`, repeating, and share all words by weight. No target
    exceeds `limit` times its source's size: the level at which sources fill up is found over the sources in the order in which
    they reach their limit. One row a source: this table alone is ordered as a whole.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    ranked = total.withColumn("weight", weight).withColumn("full_at", limit * F.col("source_size") / F.col("weight"))
    by_fill = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    filled = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(limit * F.sum("source_size").over(filled), F.lit(0.0))) / F.sum("weight").over(rest)
    leveled = ranked.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))
    leveled = leveled.withColumn("level", F.min(fits).over(everything)["level"])
    target = F.least(limit * F.col("source_size"), F.col("weight") * F.coalesce("level", F.lit(0.0)))
    return leveled.select("source", "source_size", "rows", target.cast("double").alias("target"))


#: One step of a node's fold. `s` holds the document that is still fractional (null: none) and those that are whole; `x` is the
#: next document. up: mass that x may give for s to become whole; down: the other way round. Bound once by a one-item transform.
_FOLD = """
aggregate(items, named_struct('left', cast(null as {item}), 'done', cast(array() as array<{item}>)), (s, x) ->
  CASE WHEN s.left IS NULL THEN named_struct('left', x, 'done', s.done) ELSE
    element_at(transform(array(named_struct(
        'up', least((1 - s.left.part) * s.left.size, x.part * x.size),
        'down', least(s.left.part * s.left.size, (1 - x.part) * x.size),
        'toss', (shiftrightunsigned(xxhash64(s.left.key, x.key, {seed}), 11)) / 9007199254740992D)),
      d -> element_at(transform(array(CASE WHEN d.toss * (d.up + d.down) < d.down
          THEN named_struct('a', s.left.part + d.up / s.left.size, 'b', x.part - d.up / x.size)
          ELSE named_struct('a', s.left.part - d.down / s.left.size, 'b', x.part + d.down / x.size) END),
        p -> named_struct(
          'left', CASE WHEN p.a > {near} AND p.a < 1 - {near} THEN named_struct('key', s.left.key, 'row', s.left.row, 'size', s.left.size, 'whole', s.left.whole, 'part', p.a)
                       WHEN p.b > {near} AND p.b < 1 - {near} THEN named_struct('key', x.key, 'row', x.row, 'size', x.size, 'whole', x.whole, 'part', p.b) END,
          'done', concat(s.done,
            CASE WHEN p.a > {near} AND p.a < 1 - {near} THEN cast(array() as array<{item}>)
                 ELSE array(named_struct('key', s.left.key, 'row', s.left.row, 'size', s.left.size, 'whole', s.left.whole, 'part', cast(round(p.a) as double))) END,
            CASE WHEN NOT (p.a > {near} AND p.a < 1 - {near}) AND p.b > {near} AND p.b < 1 - {near} THEN cast(array() as array<{item}>)
                 ELSE array(named_struct('key', x.key, 'row', x.row, 'size', x.size, 'whole', x.whole, 'part', cast(round(p.b) as double))) END))), 1)), 1) END)
"""
_ITEM = "struct<key: struct<id: bigint, h: bigint, n: bigint>, row: bigint, size: bigint, whole: bigint, part: double>"


def _folded(nodes: DataFrame, level: int) -> DataFrame:
    """source, node, r{left, done} of `nodes(source, node, item)`."""
    order = F.array_sort(F.collect_list(F.struct(F.xxhash64("item.key", F.lit(level)).alias("h"), "item")))
    grouped = nodes.groupBy("source", "node").agg(F.transform(order, lambda x: x["item"]).alias("items"))
    return grouped.select("source", "node", F.expr(_FOLD.format(item=_ITEM, seed=level, near=NEAR)).alias("r"))


def _told_apart(docs: DataFrame) -> DataFrame:
    """`docs(doc_id, source, size, h, row)` with n: the numbers, from 0, of rows that are alike in doc_id, source and h.

    Which of them has which number tells nothing, as they are alike; many such rows are numbered in parts.
    """
    key = F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), F.coalesce("source", F.lit("")), F.col("source").isNull(), "h")
    keyed = docs.withColumn("_key", key)
    again = stash(keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    if again.isEmpty():
        return docs.withColumn("n", F.lit(0).cast("long"))
    both = keyed.join(again, "_key", "left")
    alone = both.filter("_n IS NULL").withColumn("n", F.lit(0).cast("long"))
    many = both.filter("_n IS NOT NULL").withColumn("_part", bucket_of(["row"], F.ceil(F.col("_n") / (FAN_IN * FAN_IN))))
    columns = [*docs.columns, "n"]
    return stash(alone.select(columns).unionByName(numbered(many, ["_key"], "_part", ["row"], "n").select(columns)))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0) -> DataFrame:
    """Columns doc_id, source, size, source_size, target, copies, taken (copies x size), row of every row of
    `docs(doc_id, source, size, h, row)`.

    `size` must be 0 or more; a document of size 0 has no copies. h, a hash of the text, tells rows of one doc_id apart; row, any
    number of a row's own, is handed on. Each source's taken words differ from its target by less than its largest document. No
    document has more than `limit` copies, rounded up. Draws are hashes of doc_id, h and a number among rows that are alike in
    both: reruns agree, in any order of rows. Repeated rows are drawn each. A null source is a source, a null doc_id a document;
    no node of the tree grows with the rows of one doc_id. An empty table gives no rows; other columns are ignored.
    """
    docs = _told_apart(docs.select("doc_id", "source", "size", "h", "row"))
    targets = source_targets(docs, weights, limit)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + NEAR)
    part = F.greatest(rate - whole, F.lit(0.0))
    nodes = F.greatest(F.lit(1), F.ceil(F.col("rows") / FAN_IN))
    own = targets.withColumns({"whole": whole, "part": F.when(part > NEAR, part).otherwise(0.0), "nodes": nodes})
    own = stash(own.withColumnRenamed("source", "_source"))
    kept = ["source_size", "target"]
    same = F.col("source").eqNullSafe(F.col("_source"))
    sized = docs.select("doc_id", "source", F.col("size").cast("long"), "h", "n", "row")
    joined = sized.join(own, same).drop("_source")
    even = (F.col("part") == 0) | (F.col("size") == 0)
    item = F.struct(F.struct(F.col("doc_id").alias("id"), "h", "n").alias("key"), "row", "size", "whole", "part").cast(_ITEM)
    wide = joined.filter(~even).select("source", bucket_of(["doc_id", "h", "n"], F.col("nodes")).cast("long").alias("node"), item.alias("item"), F.col("nodes"))
    deepest = own.agg(F.max("nodes")).first()[0] or 1
    settled, level = [], 0
    while True:
        folded = stash(_folded(wide, level))
        settled.append(folded.select("source", F.explode("r.done").alias("item")))
        left = folded.filter("r.left IS NOT NULL").select("source", F.expr(f"node DIV {FAN_IN}").alias("node"), F.col("r.left").alias("item"))
        if deepest == 1:
            break
        wide, level, deepest = left, level + 1, -(-deepest // FAN_IN)
    item_of = F.col("item")
    toss = F.shiftrightunsigned(F.xxhash64(item_of["key"], F.lit(-1)), 11) / F.lit(float(1 << 53))
    last = left.select("source", item_of.withField("part", F.when(toss < item_of["part"], 1.0).otherwise(0.0)).alias("item"))
    rounded = last
    for s in settled:
        rounded = rounded.unionByName(s)
    rounded = rounded.join(own.select("_source", *kept), same)
    rounded = rounded.select(F.col("item.key.id").alias("doc_id"), F.col("item.row").alias("row"), "source", F.col("item.size").alias("size"), *kept, (F.col("item.whole") + F.col("item.part")).cast("long").alias("copies"))
    fixed = joined.filter(even).select("doc_id", "row", "source", "size", *kept, F.when(F.col("size") > 0, F.col("whole")).otherwise(0).alias("copies"))
    return rounded.unionByName(fixed).withColumn("taken", F.col("copies") * F.col("size"))


def word_count(text: Column | str) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    """Rows for `mix`, with numbers that stay: they are written once."""
    return stash(docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), *more))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0) -> DataFrame:
    """Columns doc_id, size (words), source_size, target, taken of every row of `docs(doc_id, text, source)`; see `mix`.

    A null text has no words. Other columns of `docs` are ignored, whatever their names.
    """
    return mix(_sized(docs), weights, limit).select("doc_id", "size", "source_size", "target", "taken")


def take(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0) -> DataFrame:
    """`docs(doc_id, text, source, ...)` as the mix has it: each row as often as its own copies, none included.

    Rows that share a doc_id, or have none, are documents each; of rows alike in doc_id, source and text, any are taken. Rows
    without words never are. Columns may have any names.
    An empty table gives no rows.
    """
    held = _sized(docs, F.struct(*docs.columns).alias("doc"))
    drawn = mix(held, weights, limit).filter("copies > 0").select("row", "copies")
    copied = held.select("row", "doc").join(drawn, "row")
    return copied.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
