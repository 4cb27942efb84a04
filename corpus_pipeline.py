"""A corpus from raw documents to packed sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.language import fit_languages, keep_identified
from tidelog.llm.mixing import repeated_documents
from tidelog.llm.near_dedup import one_per_group
from tidelog.llm.packing import pack
from tidelog.llm.quality import fit_quality, keep_good
from tidelog.sinks.tables import written_table

VOCABULARY = "byte_bpe_50k.json"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return keep_identified(docs, fit_languages(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely to have more than the lowest grade."""
    return keep_good(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, with the least id."""
    return one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return repeated_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return pack(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("quality", quality), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

# the trained stages have no SQL equivalent
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each one's result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir))
    return docs
