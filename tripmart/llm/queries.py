"""Registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, collocations, decontaminate, hard_negatives, jaccard_join, licenses, line_dedup, oracles, quality,
               sharding, simhash, suffix_dedup, tool_calls, toxicity)
from .common import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.verdicts(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.classes(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents")).drop("spans")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), digest=True)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                             public_tokenizers.PATTERN)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.conversation_rows(table(spark, sf_dir, "conversations"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).drop("lang")


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_line_dedup, op3_suffix_dedup, op4_quality_rules, op5_decontaminate, op6_minimax_shards,
        op7_byte_bpe, op8_simhash, op9_tool_calls, op10_toxicity, op11_jaccard_join,
        op12_collocations, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op5_decontaminate": oracles.OP5, "op9_tool_calls": oracles.OP9, "op11_jaccard_join": oracles.OP11,
            "op12_collocations": oracles.OP12, "op13_hard_negatives": oracles.OP13}
