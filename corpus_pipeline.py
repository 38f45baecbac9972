"""A training corpus from raw documents: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sojourn.llm import minhash, mixing, packing, pii, quality
from sojourn.llm.common import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    return minhash.one_per_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans are replaced by their kind."""
    return pii.without_personal_data(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once for each time the mix takes them."""
    return mixing.curriculum(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences of 2048 tokens."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixing_weights),
    ("best-fit packing", best_fit_packing),
]

#: Boosted trees and a tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
