"""A training-data pipeline: each stage applies one operator to all that its predecessor kept.

All stages but the last return the columns of their documents, whatever these are called.
Of each stage: an empty table stays empty, texts of any length are taken whole, and
nulls in other columns than ``doc_id`` and ``text`` pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import bpe, decontaminate, jaccard_join, pii, quality
from tallyspark.llm.common import ship_package, stage, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps (operator 10).

    Null and empty texts go; repeated rows share their fate; a null id stays if its text is good.
    """
    ship_package(spark)
    return quality.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates (operator 9).

    Of rows that repeat a kept id the first by text stays; rows with a null id, and texts without words, link with nothing and stay.
    """
    ship_package(spark)
    return jaccard_join.keep_one(docs)


def unseen_in_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item (operator 3).

    Rows of one id are judged together and stay or go together; null texts and null ids stay.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data masked (operator 7).

    A null text stays null; repeated rows are masked alike.
    """
    ship_package(spark)
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded bytes (operator 2).

    One row per row; a null text has no tokens, a null id stays null.
    """
    ship_package(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", good_documents), ("near-duplicates", one_of_each), ("decontamination", unseen_in_tests),
          ("pii", personal_data), ("bpe", tokens)]

#: SQL cannot express the learned and byte-level stages; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
