import random
from collections import defaultdict

from pyspark.sql import functions as F

from readloom.llm import mixing


def targets(sizes):
    """By reshaping the excess until no target is above three times its source."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        want = {s: 3.0 * sizes[s] if s in full else free * weight[s] / share for s in names}
        above = {s for s in names if want[s] > 3 * sizes[s] + 1e-9}
        if not above:
            return want
        full |= above


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    return mixing.mix_documents(df).collect()


def rows_of(seed):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice(["a"] * 9 + ["b", "c", "Z", "é", None]), None) for i in range(4000)]
    return [*rows, (5000, None, "a", None), (5001, "", "empty", None), (5002, "x " * 3000, "long", None), rows[7], (None, "a b", "b", None)]


def test_targets_and_taken(spark):
    for seed in (1, 2):
        rows = rows_of(seed)
        sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
        for _, text, source, _ in rows:
            n = len((text or "").split())
            sizes[source] += n
            largest[source] = max(largest[source], n)
        want = targets(sizes)
        source_of = {r[0]: r[2] for r in rows}
        out = run(spark, rows)
        assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
        for r in out:
            s = source_of[r.doc_id]
            assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
            assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
            taken[s] += r.taken
        for s in sizes:
            assert abs(taken[s] - want[s]) <= largest[s], s
        assert sorted(map(str, out)) == sorted(map(str, run(spark, rows[::-1])))


def test_expected_copies_are_fair(spark):
    """Long and short documents of a source are taken equally often over many sources of the same kind."""
    df = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lpad((F.col("id") / 40).cast("int"), 5, "0").alias("source"), (F.col("id") % 4 * 10 + 1).alias("size"), F.lit(0).alias("h"), F.col("id").alias("row"))
    got = mixing.mix(df).groupBy("size").agg(F.avg("copies").alias("c")).collect()
    assert max(r.c for r in got) - min(r.c for r in got) < 0.03


def test_empty_table(spark):
    assert run(spark, []) == []


def test_take_gives_each_row_its_own_copies(spark):
    """Null and shared ids, repeated rows, clashing names: the words of each source are those of the plan."""
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, i]), "w " * rng.randrange(0, 30), rng.choice(["a"] * 6 + ["b", None]), i, "x") for i in range(1500)]
    rows += [(None, "one two three", "c", 0, "y")] * 300 + [(9, None, "a", 1, "z"), (9, "", "b", 2, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies long, row string")
    out = mixing.take(docs).collect()
    assert out and list(out[0].asDict()) == docs.columns
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    for r in out:
        taken[r.source] += len(r.text.split())
    want = targets(sizes)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30, s
    assert all(r.text and r.text.strip() for r in out)
    plain = lambda rows: sorted(str((r.doc_id, r.text, r.source)) for r in rows)
    assert plain(out) == plain(mixing.take(docs.repartition(7)).collect())


def test_rows_that_are_alike_go_to_many_nodes(spark):
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit(3).alias("size"), F.lit(0).alias("h"), F.col("id").alias("row"))
    told = mixing._told_apart(docs.union(docs.limit(0)))
    assert told.select("n").distinct().count() == 20_000 and told.agg(F.max("n")).first()[0] == 19_999
    assert mixing.take(docs.select("doc_id", "source", F.lit("x").alias("text")).limit(0)).collect() == []
