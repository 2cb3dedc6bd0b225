"""Corpus pipeline: rejects poor documents, drops exact and near copies, redacts personal
data, and packs what is left into training sequences.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes its result as Parquet
under the shared checkpoint folder and reads it again as the next stage's ``docs``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import exact_dedup, ngram_join, packing, pii, quality_rules
from tidewater.llm.queries import tokenizer_file
from tidewater.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failed lines."""
    return quality_rules.clean_documents(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal contents."""
    return exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by the Jaccard join of five-word shingles at 0.8."""
    return ngram_join.drop_near_copies(docs, rule=ngram_join.Similarity(words=5, percent=80))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the names of its kinds."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("exact_dedup", dedup), ("ngram_join", near_dedup), ("pii", redact),
          ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
