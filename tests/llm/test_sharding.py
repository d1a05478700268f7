import random
import zlib

from pyspark.sql import functions as F

from readloom.llm import sharding


def plain_best_fit(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fitting = [i for i, room in enumerate(bins) if room >= s]
        if fitting:
            bins[min(fitting, key=lambda i: (bins[i], i))] -= s
        else:
            bins.append(max(capacity, s) - s)
    return bins


def test_histogram_packing_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.randrange(20, 200)
        histogram = [(s, rng.randrange(1, 30)) for s in rng.sample(range(1, 240), 25)]
        runs = sharding.best_fit_decreasing(histogram, capacity)
        rooms = {}
        for size, first, end, number in runs:
            rooms[number] = rooms.get(number, max(capacity, size)) - size * (end - first)
        want = plain_best_fit([s for s, n in histogram for _ in range(n)], capacity)
        assert sorted(rooms.values()) == sorted(want)
        for size, n in histogram:
            at = 0
            for _, first, end, _ in sorted(r for r in runs if r[0] == size):
                assert first == at < end
                at = end
            assert at == n


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int, size string")
    return sharding.shard_documents(docs).collect()


def test_equal_texts_stay_together_and_sizes_are_near_equal(spark):
    rng = random.Random(2)
    texts = ["é" * rng.randrange(1, 90) + str(i) for i in range(700)]
    rows = [(i, rng.choice(texts), "x", 1, "y") for i in range(3000)] + [(9000 + i, t, None, None, None) for i, t in enumerate((None, None, "", ""))]
    rows.append((5, rows[5][1], "x", 1, "y"))  # a repeated doc_id
    out = run(spark, rows)
    text_of = {r[0]: r[1] for r in rows}
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    shards, total = {}, {}
    for r in out:
        text = text_of[r.doc_id]
        raw = (text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert shards.setdefault((text is None, text), r.shard) == r.shard
        total.setdefault(r.shard, []).append(r)
    assert sorted(total) == list(range(8))
    for own in total.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sizes = [sum(r.size for r in own) for own in total.values()]
    assert max(sizes) - min(sizes) < 0.01 * sum(sizes)


def test_small_groups_level_what_large_ones_leave(spark):
    """A few large groups, and so many small ones that each is less than a thousandth of a shard."""
    sizes = {**{i: 40_000 + 7_000 * (i % 5) for i in range(11)}, **{100 + i: 1 + i % 60 for i in range(9_000)}}
    rows = [(i, n, k) for i, n in sizes.items() for k in ((0, 1) if i % 97 == 3 and i > 99 else (0,))]
    df = spark.createDataFrame(rows, "id long, n int, copy int")
    total = sum(n for _, n, _ in rows)
    for shards in (3, 8):
        out = sharding.shard(df, F.col("id"), F.col("n"), shards).collect()
        assert len(out) == len(rows)
        loads, of = [0] * shards, {}
        for r in out:
            loads[r.shard] += r.n
            assert of.setdefault(r.id, r.shard) == r.shard
        assert max(loads) - min(loads) <= 240 and sum(loads) == total
        assert all(sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out))) for s in range(shards))
    out = sharding.shard(df, F.col("id"), F.col("n"), None, capacity=90_000).groupBy("shard").agg(F.sum("n").alias("n")).collect()
    assert max(r.n for r in out) <= 90_000 and len(out) <= -(-total // 90_000) + 1


def test_sizes_to_the_driver_are_bounded():
    rng = random.Random(4)
    sizes = [rng.randrange(1, 200_000) for _ in range(60_000)]
    fine = sum(sizes) // 8 // sharding.FINE
    assert sum(s > fine for s in sizes) < 8 * sharding.FINE and sharding.rooms_below([50, 10, 0], 40) == [0, 15, 25]
    assert sharding.rooms_below([5, 5], 0) == [0, 0] and sharding.rooms_within([90, 20], 150, 100, 5) == [5, 75, 95]


def test_fixed_capacity_and_no_rows(spark):
    assert run(spark, []) == []
    df = spark.range(1000).withColumn("s", F.col("id") % 90 + 10)
    out = sharding.shard(df, F.col("id"), F.col("s"), capacity=1000).groupBy("shard").agg(F.sum("s").alias("s")).collect()
    assert max(r.s for r in out) <= 1000 and len(out) <= 57


def test_columns_with_the_operators_own_names(spark):
    rows = [(i % 7, f"t{i % 5}", i, i, "b") for i in range(60)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, _group string, _size long, shard long, slot string")
    out = sharding.shard(docs, F.col("_group"), F.coalesce("_size", F.lit(0)) + 1, shards=3)
    assert out.columns == ["doc_id", "_group", "_size", "shard", "slot"] and out.count() == 61
    assert out.groupBy("_group").agg(F.count_distinct("shard").alias("n")).filter("n > 1").count() == 0


def test_small_groups_are_packed_by_best_fit_decreasing_too(spark):
    """Groups of less than a thousandth of a shard lie as the plain rule has them, not end to end."""
    rng = random.Random(6)
    sizes = [rng.randrange(20_000, 60_000) for _ in range(9)] + [rng.randrange(1, 89) for _ in range(4_000)]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, n long")
    out = sharding.shard(df, F.col("id"), F.col("n"), None, capacity=90_000).groupBy("shard").agg(F.sum("n").alias("n")).collect()
    assert sorted(90_000 - r.n for r in out) == sorted(plain_best_fit(sizes, 90_000))
    even = sharding.shard(df, F.col("id"), F.col("n"), 4).groupBy("shard").agg(F.sum("n").alias("n")).collect()
    assert max(r.n for r in even) - min(r.n for r in even) <= 8


def test_rest_is_packed_whole():
    rng = random.Random(7)
    for _ in range(200):
        fine = rng.randrange(1, 30)
        histogram = [(s, rng.randrange(1, 9)) for s in rng.sample(range(1, fine + 1), rng.randrange(1, fine + 1))]
        loads = [rng.randrange(0, 300) for _ in range(rng.randrange(1, 9))]
        for capacity in (None, 300):
            runs = sharding.pack_rest(histogram, loads, capacity, fine)
            held = dict(enumerate(loads))
            for size, first, end, number in runs:
                held[number] = held.get(number, 0) + size * (end - first)
            assert all(sum(e - f for s, f, e, _ in runs if s == size) == n for size, n in histogram)
            level = max(load + room for load, room in zip(loads, sharding.rooms_below(loads, sum(s * n for s, n in histogram)), strict=True))
            assert max(held.values()) <= (capacity or level + fine + 1)
