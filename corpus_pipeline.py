"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup,
benchmark decontamination, byte-level BPE encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read back as the next stage's ``docs``; all but the
last return the columns of ``documents``.  Side tables (labels, benchmark)
come from ``sf_dir``, corpus facts from ``docs`` alone.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import bpe, decontaminate, line_dedup, quality, simhash
from tripmart.llm.common import stage, table
from tripmart.llm.queries import VOCABULARY


def _filtered(docs: DataFrame, judge: Callable[[DataFrame, tuple[str, ...]], DataFrame], condition: str) -> DataFrame:
    """Rows of ``docs`` whose verdict meets ``condition``; all columns travel under
    numbered names, so none can clash with a verdict's."""
    numbered = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, numbered)], "text", "doc_id")
    return judge(plain, tuple(numbered)).where(condition).select(
        *[F.col(n).alias(c) for c, n in zip(docs.columns, numbered)])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    crf = quality.train(docs, table(spark, sf_dir, "labels"))
    return _filtered(docs, lambda d, keep: quality.judge(d, crf, keep=keep), "kept")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat another's; those left without a word go."""
    return line_dedup.deduplicated(docs).where(F.col("text").rlike(r"\S"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.one_of_each(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    bench = table(spark, sf_dir, "benchmark")
    return _filtered(docs, lambda d, keep: decontaminate.scan(d, bench, keep=keep, digest=True), "n_hit = 0")


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, decoded``: token ids of every document and the bytes they decode to."""
    return bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", simhash_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("byte-level BPE", encode_stage),
]

# A fitted labeller, components and a merge order can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
