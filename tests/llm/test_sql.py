import duckdb
import pytest

from readloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    plain = lambda row: tuple(str(round(v, 9)) if isinstance(v, float) else str(v) for v in row)
    rows = queries.queries()[name](spark, SF).select(*names).collect()
    assert sorted(map(plain, rows)) == sorted(map(plain, found.fetchall()))
