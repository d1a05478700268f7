"""Every registered query of the core gives the rows of its SQL in DuckDB, on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

from readloom import plans
from readloom.plans.registry import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return "nan" if isinstance(v, float) and math.isnan(v) else f"{float(v):.6g}" if abs(v) < 1e15 else str(v)
    return str(v)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_matches_sql(spark, db, name):
    df = plans.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in plans.SQL:
        return
    found = db.execute(plans.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in sorted(names)) for r in rows) == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
