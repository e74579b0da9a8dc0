"""From raw documents to token ids: rules, exact and near duplicates, mix, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.llm import bpe, exact_dedup, minhash, mixing, quality_rules
from gradus.llm.text_queries import rank_file
from gradus.sources.tables import materialise


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source targets take them."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids (little-endian, 32 bits) and their number, and digests of the ids and of what they decode to."""
    coded = bpe.round_trip(docs.select("doc_id", "text"), rank_file(), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [("quality rules", rules), ("exact dedup", exact), ("MinHash near-dedup", near), ("mixing", mixed), ("byte-level BPE", encoded)]

#: Encoding and connected components are beyond SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
