"""Costly expressions are worked out once, and only where they must be."""

from pyspark.sql import functions as F

from readloom.functions import seq
from readloom.operators import pairing


def test_censoring_looks_at_bad_cycles_alone(spark):
    reads = spark.createDataFrame([(1, 1, 5, "", ""), (1, 2, 5, "ACGT", "IIII"), (2, 1, 5, "ACGT", "IIII"), (3, 1, 6, "AC", "II"), (4, 1, 5, None, None)], "pair_id int, mate int, tile int, seq string, qual string")
    bad = spark.createDataFrame([(5, 1), (5, 3), (5, 9), (5, -4), (5, 0)], "tile int, cycle long")
    out = {(r.pair_id, r.mate): (r.seq, r.qual) for r in pairing.censored(reads, bad).collect()}
    assert out == {(1, 1): ("", ""), (1, 2): ("ACGN", "III#"), (2, 1): ("NCNT", "#I#I"), (3, 1): ("AC", "II"), (4, 1): (None, None)}


def test_a_merge_is_written_out_once(spark):
    sam = spark.createDataFrame([("q", 99, "r", 1, "4M", "ACGT", "IIII", 1), ("q", 147, "r", 3, "4M", "GTAA", "IIII", 2)], "qname string, flag int, rname string, pos int, cigar string, seq string, qual string, mate int")
    out = pairing.merge_pairs(sam).filter("merged IS NOT NULL").select("qname", "merged")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("arrays_zip(") == 1
    assert [tuple(r) for r in out.collect()] == [("q", "ACGTAA")]


def test_mixtures_between_plain_bases(spark):
    rows = [("ACGTRACGYT",), ("",), ("R",), ("AC?G",), ("A\nC",), (None,), ("ACGT",)]
    df = spark.createDataFrame(rows, "s string").select("s", seq.concrete_sequences("s").alias("x"))
    expected = {"ACGTRACGYT": ["ACGT" + a + "ACG" + b + "T" for a in "AG" for b in "CT"], "": [""], "R": ["A", "G"], "AC?G": None, "A\nC": None, None: None, "ACGT": ["ACGT"]}
    assert {r.s: r.x and sorted(r.x) for r in df.collect()} == {s: x and sorted(x) for s, x in expected.items()}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "([ACGT]+|" in plan and "split(" not in plan  # plain bases go as one, not letter by letter
