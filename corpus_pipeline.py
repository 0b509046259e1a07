"""Corpus pipeline: documents in, an interleaved training mix out.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each stage's result as Parquet in the shared checkpoint folder and
reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricetide.llm.common import read, stored
from pricetide.llm.decontam import drop_contaminated
from pricetide.llm.mixing import mixed_in_order
from pricetide.llm.secrets import mask_secrets
from pricetide.llm.simhash import keep_one
from pricetide.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject."""
    return reject_toxic(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets masked in their texts."""
    return mask_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix, written in that order."""
    return mixed_in_order(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
]

# Hash-based and learned stages have no SQL form; tests hold them against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
