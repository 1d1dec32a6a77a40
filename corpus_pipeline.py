"""From raw documents to token ids, in five stages.

Each stage takes all documents its predecessor kept and returns the columns of
``documents``; the last one returns token ids. ``run`` writes what a stage returns to
the shared folder and hands the written table to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.llm import byte_bpe, exact_dedup, jaccard_join, quality_rules, source_mix
from penmark.llm.common import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.keep_distinct(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, similarity 0.8 or more) the one with the smallest id stays."""
    return jaccard_join.keep_one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, one row per document and pass over its source."""
    return source_mix.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return byte_bpe.encode(docs).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("source_mix", mix),
    ("byte_bpe", encode),
]

# SQL can neither fit the rules' model nor merge byte pairs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
