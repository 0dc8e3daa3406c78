"""Registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import (bpe, decontaminate, embed_dedup, jaccard_join, maxscore, periodic_runs, pii, quality, substring_dedup,
               token_store, toxicity, warc, whitening)
from .common import ship_package, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and keeper of every vector of ``embeddings``; see ``embed_dedup.near_duplicates``."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and the decoded bytes of every text of ``documents``; see ``bpe.round_trip``."""
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold; see ``decontaminate.search``."""
    return decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``pages`` written to WARC archives and read back; see ``warc.pages_from``."""
    path = scratch_path(spark, "warc")
    warc.archive_pages(table(spark, sf_dir, "pages"), path)
    return warc.pages_from(spark, path)


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` written to the token store and read back; see ``token_store.positions``."""
    path = scratch_path(spark, "token-ids")
    token_store.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"),
                      public_tokenizers.PATTERN)
    return token_store.positions(token_store.read(spark, path))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts and digest of every text of ``documents`` without repeated passages; see ``substring_dedup.digest``."""
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text of ``documents``; see ``pii.digest``."""
    return pii.digest(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text of ``documents``, learnt from ``labels`` outside the held-out fold; see ``toxicity.score``."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every text of ``documents``; see ``jaccard_join.components_of``."""
    return jaccard_join.components_of(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak label, score and verdict for every text of ``documents``; see ``quality.classify``."""
    return quality.classify(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen whitened components of every vector of ``embeddings``; see ``whitening.whiten``."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows of greatest inner product for each vec_id divisible by 50 in ``embeddings``; see ``maxscore.top_k``."""
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every text of ``documents`` and its digest without them; see ``periodic_runs.digest``."""
    return periodic_runs.digest(table(spark, sf_dir, "documents"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    run.__doc__ = query.__doc__
    return run


QUERIES: dict[str, Query] = {q.__name__: _shipped(q) for q in (
    op1_embedding_dedup, op2_bpe_round_trip, op3_decontamination, op4_warc, op5_token_store, op6_substring_dedup,
    op7_pii, op8_toxicity, op9_jaccard_join, op10_quality, op11_embedding_whitening,
    op12_exact_top_k, op13_periodic_runs)}

#: SQL for those queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {
    "op1_embedding_dedup": embed_dedup.SQL, "op3_decontamination": decontaminate.SQL, "op6_substring_dedup": substring_dedup.SQL,
    "op9_jaccard_join": jaccard_join.SQL, "op12_exact_top_k": maxscore.SQL}
