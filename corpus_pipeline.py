"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from brisa.llm import decontamination, jaccard, packing, quality_rules, secrets
from brisa.llm.queries import table
from brisa.llm.tokens import tokenizer_path
from brisa.session import configure, scratch, shared_folder
from brisa.sources.writers import remove


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return jaccard.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a notable share of benchmark passages."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their ids."""
    return packing.digest(packing.pack(docs, tokenizer_path("byte_bpe_50k.json")))


STAGES = [
    ("quality rules", rules),
    ("n-gram Jaccard join", unique),
    ("benchmark decontamination", uncontaminated),
    ("secret scans", without_secrets),
    ("packing", packed),
]

# The classifier, the decoding worklist and the tokenizer are not in SQL; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; what a stage wrote on the way goes when the next one has its documents."""
    docs, before = table(configure(spark), sf_dir, "documents"), None
    for _, stage in STAGES:
        path = f"{shared_folder(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
