from readloom.sources import files


def test_empty_sequences_stay_empty(spark):
    rows = [(1, "a", ""), (2, "a", "acg"), (3, "", "t"), (None, None, None)]
    out = files.contigs_of(spark.createDataFrame(rows, "n int, region string, contig string"), "n").collect()
    assert sorted(map(tuple, out), key=str) == sorted([("a", ""), ("a_1", "ACG"), ("contig4", "T"), ("contig1", None)], key=str)
    both = spark.createDataFrame([(1, "", "ac"), (2, "", ""), (3, None, "")], "n int, sequence string, contig string")
    assert sorted((r.name, r.sequence) for r in files.contigs_of(both, "n").collect()) == [("contig1", "AC"), ("contig2", ""), ("contig3", "")]
