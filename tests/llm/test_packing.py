import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from readloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fitting = [r for r in rooms if r >= s]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - s)
        else:
            rooms.append(capacity - s)
    return rooms


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(80):
        capacity = rng.randrange(10, 120)
        counts = {s: rng.randrange(1, 40) for s in rng.sample(range(1, capacity + 1), rng.randrange(1, capacity))}
        taken, where = {}, []
        for length, rank, each, first, offset in packing.plan(counts, capacity):
            where.append((length, rank, each, first, offset))
        for length, n in counts.items():
            own = [w for w in where if w[0] == length]
            for rank in range(n):
                _, low, each, first, offset = max((w for w in own if w[1] <= rank), key=lambda w: w[1])
                taken.setdefault(first + (rank - low) // each, []).append((offset + (rank - low) % each * length, length))
        assert sorted(taken) == list(range(len(taken)))
        rooms = []
        for parts in taken.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            rooms.append(capacity - at)
        assert sorted(rooms) == sorted(plain_best_fit([s for s, n in counts.items() for _ in range(n)], capacity)) and min(rooms) >= 0


def test_ids_equal_those_of_whole_texts():
    texts = ["Hello, World! it's\n\tÉtÉ 12ab", "a b c  d\x1ce", "é ́x ΣΑΣ straße", "", "x" * 500, "<|endoftext|>a <|startoftext|>", "<|ENDOFTEXT|> <|endoftext|", "B<|endoftext|>.C"]
    rng = random.Random(3)
    texts += ["".join(rng.choices(["a", "B", "'s", "'", ".", "$$", "!", " ", "é", "́", "̱", "H", "9", "…", "-", "<|", "\n", "don't."], k=30)) for _ in range(400)]
    latin = [chr(c) for c in range(0xA0, 0x260)] + list("abcXYZ019.,;'-_|<>#\"\\`{}~^[]@") + ["\x1c", "\x7f", "\u2028", "Σ", "İ", "ſ", "ǅ"]
    texts += ["".join(rng.choices([*latin, " "], k=40)) for _ in range(2000)] + [a + b for a in latin for b in (".", "a", "1", "'s", "")]
    texts += [" ".join("".join(rng.choices("aeinrstüßé", k=rng.randrange(1, 15))) for _ in range(20)) for _ in range(200)]
    encoder, whole = packing.ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    for t in texts * 2:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_a_full_cache_changes_no_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 5)
    encoder, whole = packing.ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    for t in ["one two three four", "five six seven, eight nine", "one 2 thr33 it's é!"] * 3:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [32, 2048])
def test_every_piece_has_its_place(spark, capacity):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["ab", "the", "zq", "é!"], k=rng.randrange(0, 90))), "extra") for i in range(400)]
    rows += [(1000, None, None), (1001, "", None), (3, rows[3][1], None), (1002, "word " * 5000, None), ((1 << 60) + 1, "one", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    out = packing.pack(docs, PATH, capacity).collect()
    whole = Tokenizer.from_file(PATH)
    want = []
    for doc, text, _ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(doc, n, at, len(ids[at : at + capacity]), zlib.crc32(np.array(ids[at : at + capacity], "<u4").tobytes())) for n, at in enumerate(range(0, len(ids), capacity))]
    assert sorted(r[:5] for r in map(tuple, out)) == sorted(want)
    used = {}
    for r in out:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) == len(plain_best_fit([w[3] for w in want], capacity))


def test_null_ids(spark):
    out = packing.pack(spark.createDataFrame([(None, "a b"), ((1 << 60) + 1, "c")], "doc_id long, text string"), PATH).collect()
    assert {r.doc_id for r in out} == {None, (1 << 60) + 1} and len({r.sequence_id for r in out}) == 1


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
