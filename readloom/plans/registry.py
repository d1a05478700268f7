"""Registration of queries, and lenses that give the test tables the shapes of reads, reports and runs.

Lenses use whole tables and whole texts: a document's letters are cut into consecutive reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_LETTERS = "'abcdefghijklmnopqrstuvwxyz'"
_PIECES = "SELECT doc_id, i, substr(seq, CAST({n} * i + 1 AS INT), {n}) AS seq, substr(letters, CAST({n} * i + 1 AS INT), {n}) AS letters FROM ({rows}) cut"
_SPARK_PIECES = "SELECT doc_id, i, p.s AS seq, p.l AS letters FROM (SELECT doc_id, posexplode(zip_with(regexp_extract_all(seq, '(.{{{{1,{n}}}}})'), regexp_extract_all(letters, '(.{{{{1,{n}}}}})'), (s, l) -> named_struct('s', s, 'l', l))) AS (i, p) FROM seqs) cut"
_DUCK_ROWS = "SELECT doc_id, seq, letters, unnest(range(0, (length(seq) - 1) // {n} + 1)) AS i FROM seqs WHERE length(seq) > 0"
_CUT = "CASE WHEN (pair_id * 2 + mate) % 17 = 0 THEN '*' WHEN length(seq) < 60 THEN concat(length(seq), 'M') WHEN (pair_id * 2 + mate) % 5 = 0 THEN '60M' WHEN (pair_id * 2 + mate) % 5 = 1 THEN '10S50M' WHEN (pair_id * 2 + mate) % 5 = 2 THEN '30M3D30M' WHEN (pair_id * 2 + mate) % 5 = 3 THEN '20M6I34M' ELSE '40M20S' END"
_PAIR = "doc_id * 65536 + CAST(floor(i / 2) AS BIGINT)"

#: Lens: the tables or lenses it reads, its SQL in Spark and in DuckDB (None: the same).
LENSES: dict[str, tuple[tuple[str, ...], str, str | None]] = {
    "seqs": (
        ("documents",),
        f"SELECT doc_id, source, lang, n_chars, regexp_replace(lower(text), '[^a-z]', '') AS letters, translate(regexp_replace(lower(text), '[^a-z]', ''), {_LETTERS}, 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM documents",
        f"SELECT doc_id, source, lang, n_chars, regexp_replace(lower(text), '[^a-z]', '', 'g') AS letters, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), {_LETTERS}, 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM documents",
    ),
    "pieces150": (("seqs",), _SPARK_PIECES.format(n=150), _PIECES.format(n=150, rows=_DUCK_ROWS.format(n=150))),
    "pieces60": (("seqs",), _SPARK_PIECES.format(n=60), _PIECES.format(n=60, rows=_DUCK_ROWS.format(n=60))),
    "reads": (
        ("pieces150",),
        f"SELECT {_PAIR} AS pair_id, CAST(1 + i % 2 AS INT) AS mate, 1101 + (doc_id + i) % 7 AS tile, seq, translate(letters, {_LETTERS}, '#$%&()*+-./0123456789:;<=>') AS qual FROM pieces150",
        None,
    ),
    "sam": (
        ("pieces60",),
        f"SELECT concat('q', pair_id) AS qname, CAST(CASE WHEN (pair_id * 2 + mate) % 17 = 0 THEN 4 WHEN mate = 1 THEN 99 ELSE 147 END AS INT) AS flag, "
        f"concat('ref', CASE WHEN mate = 2 AND pair_id % 13 = 0 THEN (pair_id + 1) % 4 ELSE pair_id % 4 END) AS rname, 1 + pair_id % 20 + (mate - 1) * 30 AS pos, 40 + pair_id % 5 AS mapq, {_CUT} AS cigar, seq, qual, pair_id, mate "
        f"FROM (SELECT {_PAIR} AS pair_id, CAST(1 + i % 2 AS INT) AS mate, seq, translate(letters, {_LETTERS}, '#$%&()*+-./0123456789:;<=>') AS qual FROM pieces60) r",
        None,
    ),
    "aligned": (
        ("pieces60",),
        "SELECT concat('ref', doc_id % 4) AS refname, 15 AS qcut, 1 + (doc_id + i) % 3 AS cnt, (doc_id + i) % 30 AS off, doc_id * 65536 + i AS ord, "
        "CASE WHEN (doc_id + i) % 6 = 0 THEN concat(substr(seq, 1, 30), '---', substr(seq, 34, 27)) WHEN (doc_id + i) % 9 = 1 THEN concat(substr(seq, 1, 9), 'N', substr(seq, 11, 50)) "
        "WHEN (doc_id + i) % 11 = 2 THEN concat(substr(seq, 1, 39), 'nnn', substr(seq, 43, 18)) ELSE seq END AS seq FROM pieces60",
        None,
    ),
    "quality": (
        ("lineitem",),
        "SELECT l_orderkey AS tile, CASE WHEN l_linenumber % 2 = 0 THEN -l_linenumber ELSE l_linenumber END AS cycle, CASE WHEN l_linenumber = 7 THEN NULL ELSE round(max(l_discount) * 100) END AS errorrate FROM lineitem GROUP BY l_orderkey, l_linenumber",
        None,
    ),
    "spans": (("documents",), "SELECT doc_id AS id, concat('ref', doc_id % 5) AS ref, (doc_id * 7919) % 40000 AS r_st, (doc_id * 7919) % 40000 + 20 + n_chars % 180 AS r_ei, n_chars AS reads FROM documents", None),
    "runs": (("lineitem",), "SELECT concat(l_returnflag, l_linestatus) AS app, l_orderkey AS run_id, concat('s', l_partkey % 50) AS sample, l_discount AS concordance, l_quantity AS depth, l_extendedprice AS run_time, l_linenumber AS line FROM lineitem", None),
    "scores": (("orders",), "SELECT o_custkey AS sample, o_orderpriority AS project, concat('R', o_orderkey % 6) AS region, concat('seed', o_orderkey % 3) AS seed, 1 + o_orderkey % 4 AS on_score, -(o_orderkey % 4) AS off_score, o_orderkey AS ord FROM orders", None),
    "aminos": (
        ("lineitem",),
        "SELECT concat('HCV-', 1 + l_suppkey % 6, CASE WHEN l_suppkey % 2 = 0 THEN 'a' ELSE 'b' END) AS seed, 1 + l_partkey % 60 AS pos, substr('ACDEFGHIKLMNPQRSTVWY*', CAST(1 + l_suppkey % 21 AS INT), 1) AS amino, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2, 3",
        None,
    ),
    "file_events": (("events",), "SELECT user_id AS run, event_type AS kind, ts, event_id AS ord FROM events", None),
}


def lens(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lens, or a table itself."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inputs, sql, _ = LENSES[name]
    for i in inputs:
        sql = sql.replace(f"FROM {i}", f"FROM {{{i}}}")
    return spark.sql(sql, **{i: lens(spark, sf_dir, i) for i in inputs})


def duck(sql: str, *names: str) -> str:
    """`sql` with the lenses before it that it and they read."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in LENSES and name not in ordered:
            for i in LENSES[name][0]:
                need(i)
            ordered.append(name)

    for n in names:
        need(n)
    parts = [f"{n} AS ({LENSES[n][2] or LENSES[n][1]})" for n in ordered]
    body = sql.strip()
    if not parts:
        return body
    return f"WITH {', '.join(parts)}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {', '.join(parts)} {body}"


def query(name: str, sql: str | None, *lenses: str) -> Callable:
    """Register a function of (spark, sf_dir); or of the DataFrames of `lenses`, in that order."""

    def register(f: Callable) -> Callable:
        QUERIES[name] = (lambda spark, sf_dir: f(*(lens(spark, sf_dir, n) for n in lenses))) if lenses else f
        if sql is not None:
            SQL[name] = duck(sql, *lenses)
        return f

    return register
