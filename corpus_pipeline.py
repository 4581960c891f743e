"""The documents, stage by stage, from raw rows to packed training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from causalgrid.llm import near_dedup, packing, quality_rules, suffix_dedup, toxicity
from causalgrid.llm.common import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without their failed lines."""
    return quality_rules.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a lexicon learned from ``labels`` does not call toxic."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles agree by 0.8 or more."""
    return near_dedup.without_near_duplicates(docs, width=5, percent=80)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 400-byte strings and the passages of over 50 words that start elsewhere as well."""
    return suffix_dedup.without_repeats(docs, words=51)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and the sequences of 2048 tokens that hold them."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near-dedup", near_dedup_stage),
    ("suffix dedup", suffix_dedup_stage),
    ("packing", packing_stage),
]

#: Several stages learn or hash in ways that SQL cannot say; tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
