"""The corpus run: each stage works on all documents that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is written as Parquet and
reread as the next one's documents, so a lost executor costs tasks of one stage only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rooftally.llm.common import ready, staged
from rooftally.llm.decontaminate import drop_contaminated
from rooftally.llm.exact_dedup import drop_copies
from rooftally.llm.packing import pack
from rooftally.llm.simhash import drop_near_copies
from rooftally.llm.toxicity import drop_toxic, learn


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of multiple-instance learning rejects go. It learns from ``labels`` as far as they are in ``docs``."""
    return drop_toxic(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal folded texts, the one with the largest id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of three-word shingles that differ in 3 bits or fewer, the one with the smallest id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Components of similar texts, a trained classifier and byte-pair encoding are beyond SQL: tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
