"""The corpus pipeline: quality rules, exact dedup, near-dedup, packing.

Each stage reads what its predecessor wrote. The first three drop documents
and return the columns of ``documents``; the last returns packed pieces.

Odd input: null and empty texts have too few words and go in the first stage;
a null id is the smallest, so it loses to any other in exact dedup and stays
first in near-dedup; of rows that repeat id and text one stays, rows that
repeat an id with other texts are one document to near-dedup; extra columns
pass through to the last stage whatever their names; an empty table stays
empty. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseloom.llm import exact_dedup, minhash, packing, quality
from caseloom.session import settle, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id."""
    return minhash.drop_near(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, with their token ids."""
    return packing.pack_documents(docs, max_words=60_000)  # executors still hold what earlier stages left


STAGES = [("quality_rules", quality_rules), ("exact_copies", exact_copies), ("near_copies", near_copies), ("packing", packed)]

#: Shingle similarity classes and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
