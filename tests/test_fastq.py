import gzip
import random

import pytest

from readloom.sources import fastq, files


def made(rng, n):
    return [(f"r{i} x", s := "".join(rng.choices("ACGTN", k=rng.choice((0, 1, 7, 60)))), "".join(rng.choices("@+I#", k=len(s)))) for i in range(n)]


def text(rows, end="\n"):
    return "".join(f"@{n}{end}{s}{end}+{end}{q}{end}" for n, s, q in rows)


def test_stretches_hold_each_record_once_wherever_they_are_cut(tmp_path):
    rng = random.Random(1)
    for end in ("\n", "\r\n"):
        rows = [r for r in made(rng, 40) if r[1]]
        raw = text(rows, end)
        (tmp_path / "a.fastq").write_bytes(raw.encode())
        for size in (1, 2, 3, 10, 64, 500, 10**6):
            cuts = list(range(0, len(raw), size))
            found = [r for a, b in zip(cuts, [*cuts[1:], None]) for r in fastq.records(str(tmp_path / "a.fastq"), a, b)]
            assert [(n[1:].decode(), s.decode(), q.decode()) for _, (n, s, _, q) in found] == rows
            assert all(raw[at] == "@" for at, _ in found)


def test_folder_of_plain_and_gz_files(spark, tmp_path):
    rng = random.Random(2)
    rows = made(rng, 900)
    (tmp_path / "a.fastq").write_text(text(rows[:500]))
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(text(rows[500:]).encode()))
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / "none.fastq").write_text("")
    df = fastq.read_fastq(spark, str(tmp_path), split=2_000)
    assert sorted((r.name, r.seq, r.qual) for r in df.collect()) == sorted(rows)
    assert df.rdd.getNumPartitions() > 5 and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_cut_off_and_broken_records_are_errors(spark, tmp_path):
    whole = text([("a", "ACGT", "IIII"), ("b", "AC", "II")])
    for broken in (whole[:-1].rsplit("\n", 1)[0] + "\n", whole.replace("+\nII\n", "+\nI\n"), "@a\nAC\n"):
        (tmp_path / "x.fastq").write_text(broken)
        with pytest.raises(ValueError, match="cut off|no record"):
            list(fastq.records(str(tmp_path / "x.fastq"), 0, None))
    (tmp_path / "x.fastq").write_text(whole + "\n")
    assert len(list(fastq.records(str(tmp_path / "x.fastq"), 0, None))) == 2


def test_lines_meet_by_record_not_by_block(spark, tmp_path):
    """Several files in blocks of a few lines, one empty, one whose last line has no end: only records are shuffled, without paths."""
    want = []
    for f, n in enumerate((40, 0, 7, 1)):
        records = [(f"f{f}r{i}", "ACGT" * (i % 9), "@+II" * (i % 9)) for i in range(n)]
        text = "\n".join(f"@{name}\n{seq}\n+\n{qual}" for name, seq, qual in records)
        (tmp_path / f"{f}.fastq").write_text(text + "\n" * (n > 0 and f != 2))
        want += [(f"{f}.fastq", i, *r) for i, r in enumerate(records)]
    conf = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = files.read_fastq(spark, str(tmp_path))
        found = sorted((r.file.rsplit("/", 1)[1], r.record, r.name, r.seq, r.qual) for r in out.collect())
        plan = out.select("name", "seq")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == sorted(want) and len(found) == 48
    grouped = next(line for line in plan.split("\n") if "Aggregate" in line)
    assert "strategy=broadcast" in plan and "file" not in grouped
