"""The queries of this package's operators: one per operator, over whole tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import merkle, nbsvm, oracles, ownership, packing, parity_join, pii, simple8b, sparse_suffix, suffix_tree, winnowing


def vocabulary() -> str:
    """The tokenizer file of the packing and binary-output queries; MILLRACE_VOCABULARY names another."""
    if named := os.environ.get("MILLRACE_VOCABULARY"):
        return named
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_ownership_secrets(spark: SparkSession, d: str) -> DataFrame:
    return ownership.scan(_table(spark, d, "documents"), owner="source", repo="lang")


def op2_suffix_tree_scores(spark: SparkSession, d: str) -> DataFrame:
    return suffix_tree.score(_table(spark, d, "documents").select("doc_id", "text"), mod=7, rest=2)


def op3_merkle_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return merkle.compare(_table(spark, d, "documents"))


def op4_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(_table(spark, d, "documents"))


def op5_winnowing_decontamination(spark: SparkSession, d: str) -> DataFrame:
    found = winnowing.decontaminate(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_sparse_suffix_repeats(spark: SparkSession, d: str) -> DataFrame:
    return sparse_suffix.repeats(_table(spark, d, "documents").select("doc_id", "text"), span=50)


def op7_parity_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return parity_join.similar(_table(spark, d, "documents").select("doc_id", "text"), k=5, num=80, den=100).select("doc_id", "n_shingles", "component_id")


def op8_residual_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_table(spark, d, "documents"), vocabulary(), end_id=0, capacity=2048)


def op9_simple8b_output(spark: SparkSession, d: str) -> DataFrame:
    return simple8b.round_trip(_table(spark, d, "documents"), vocabulary(), end_id=1)


def op10_quality_nbsvm(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    model = nbsvm.fit(docs, _table(spark, d, "labels"), "quality", mod=3, rest=1)
    scored = nbsvm.score(docs.select("doc_id", "text"), model)
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.expr("coalesce(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, false)").alias("held_out"),
        "score", F.expr("cast(score >= 0.5 as int)").alias("predicted"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ownership_secrets, op2_suffix_tree_scores, op3_merkle_fingerprints, op4_pii, op5_winnowing_decontamination, op6_sparse_suffix_repeats, op7_parity_jaccard_join, op8_residual_packing, op9_simple8b_output, op10_quality_nbsvm)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
