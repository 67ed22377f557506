"""A training-data pipeline of five stages, each one of the llm operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of `documents`. Nulls: a null text counts as empty. At the near-duplicate
stage each row is a document of its own, also without a doc_id or with another's. An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import nbsvm, packing, parity_join, pii, winnowing
from millrace.llm.common import materialise, shared_dir
from millrace.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score under 0.5) go."""
    docs = docs.select(*COLUMNS)
    model = nbsvm.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", mod=3, rest=1)
    return nbsvm.score(docs, model).where("score >= 0.5").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the Jaccard join stays: the one with the smallest doc_id, rows without one last. Documents without words stay."""
    rows = materialise(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), shared_dir(spark), "rows")
    found = parity_join.similar(rows.select(F.col("_row").alias("doc_id"), "text"), k=5, num=80, den=100).select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text", "lang", "source", "n_chars").alias("hash"), "_row")
    keep = found.join(rows.select("_row", order.alias("_o")), "_row").groupBy("component_id").agg(F.min("_o").alias("_o")).select("_o._row")
    return rows.join(keep, "_row", "left_semi").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    found = winnowing.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=True)
    return found.where("not contaminated").select(*COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind in brackets; n_chars follows."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece of a document."""
    return packing.pack(docs, vocabulary(), end_id=0, capacity=2048)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("private_data", private_data), ("packing", packed)]

#: The classifier and the tokenizer can't be put in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, where, name)
    return docs
