"""Nothing is left out by its size."""

import random

import duckdb

from readloom import plans
from readloom.plans import calls


def test_long_references_drift_too(spark, tmp_path):
    """A turn of over 10,000 letters is asked whether it has drifted, as its SQL asks all."""
    rng = random.Random(7)
    text = lambda n: "".join(rng.choices("abcdfgjkpqt", k=n))
    long = text(10_050)
    turns = ["e" + long, text(20), text(31), long[:400] + "zz" + long[410:], text(10)]
    rows = [(1, i, "user", t if len(t) % 7 != 5 else t + "a") for i, t in enumerate(turns)] + [(2, 0, "user", text(10_010)), (2, 1, "user", "abc")]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(con.execute(plans.SQL["i1_drifted_references"]).fetchall())
    found = sorted(map(tuple, calls.i1(spark.read.parquet(path)).collect()))
    assert found == want
    assert (1, 0, False) in {(r[0], r[1], r[5]) for r in want}
