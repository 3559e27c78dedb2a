"""Corpus cleaning in five stages, each one operator of ``strata.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
each stage's rows as Parquet and rereads them as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import packing, quality, rules, secrets, simhash
from strata.llm.common import table, written
from strata.llm.queries import BPE_JSON, vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this input and its labels, accepts."""
    return quality.filter_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the production policy."""
    return rules.filter_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary(BPE_JSON))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the fitted classifier nor the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
