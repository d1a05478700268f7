"""From raw documents to packed training sequences: five stages, each of which works on all that its predecessor kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import mixing, packing, quality, simhash, spans
from readloom.llm.common import shared_dir, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by the labels, doesn't reject. Texts that share a doc_id, or have none, are judged each."""
    same = lambda text: F.md5(F.coalesce(text, F.lit("")))
    slim = docs.select("doc_id", "text", same("text").alias("same"))
    verdicts = quality.classify(slim, table(spark, sf_dir, "labels"), ("same",))
    rejected = verdicts.filter("predicted = 0").select("doc_id", "same").distinct()
    held = docs.select(F.struct(*docs.columns).alias("doc"))  # in a struct, no column's name can clash
    mine = held["doc.doc_id"].eqNullSafe(rejected["doc_id"]) & (same(held["doc.text"]) == rejected["same"])
    return held.join(rejected, mine, "left_anti").select("doc.*")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash.one_of_each_group(docs, width=5, similarity=0.8)


def without_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without sentences that an earlier document has; a document of which nothing is left goes. A null text stays null."""
    cut = spans.dedup_spans(docs)
    left = cut.filter((F.col("removed_sentences") == 0) | (F.trim("text") != ""))
    return left.withColumn("n_chars", F.when(F.col("removed_sentences") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop("removed_sentences")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("near_copies", one_of_near_copies),
    ("spans", without_repeated_spans),
    ("mixing", mixed),
    ("packing", packed),
]

#: Statistics, fingerprints and tokens are beyond SQL: stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
