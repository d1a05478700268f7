"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import chat, licences, merkle, middle, minhash, mixing, packing, quality, rules, sharding, simhash, spans, spelling, sql
from readloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=2)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


def op4_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op11_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = middle.fill_in_middle(table(spark, sf_dir, "documents"), seed=7, per_cent=100, spm_per_cent=50)
    digest = lambda text: F.sha2(text, 256)
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest(middle.restored("output", "form")).alias("restored_sha256"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=5, per_cent=85)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), least_letters=6, least_count=5, times=5, slip=199)


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op5_chat": sql.OP5, "op9_merkle": sql.OP9, "op11_middle": sql.OP11, "op12_minhash": sql.OP12, "op13_spelling": sql.OP13}
