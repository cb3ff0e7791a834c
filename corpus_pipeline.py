"""A training corpus from raw documents: language, exact copies, near copies, mix, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and is written as Parquet and read again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patchloom.llm.exact_dedup import drop_exact_copies
from patchloom.llm.language import keep_identified, learnable, train
from patchloom.llm.minhash import drop_near_copies
from patchloom.llm.mixing import take_mix
from patchloom.llm.packing import pack_documents
from patchloom.session import scratch_path

# Learning and ties depend on models and hashes that SQL can't express; the tests use a brute-force version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the codeword classifiers can tell; texts without a letter go."""
    return keep_identified(docs, train(learnable(docs)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the largest id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8), the one with the smallest id."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to weights 5, 2, 1; a document appears as often as the mix takes it, at most three times."""
    return take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1,024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
