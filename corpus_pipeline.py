"""A training-corpus pipeline: toxic documents out, one of each near-duplicate group kept, benchmark
leaks out, personal data masked, texts encoded as tokens and decoded again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of their input. ``run`` writes every stage's result to the shared folder and reads it again, which
also cuts lineage, so that a lost executor costs one stage's tasks at most.

Defined results: documents with NULL or empty text pass every stage (they are never toxic, near
duplicates or leaks, and have no tokens). Repeated rows with one id come out of the second stage
once. Columns beyond those of documents are carried along. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm import decontaminate, near_dup, personal_data, tokenize, toxicity
from hardwood.llm.common import ship, table
from hardwood.sinks.scratch import keep

# SQL has no form for learned scores, masks by a random field, or tokens.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), teaches=toxicity.taught())
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dup.one_of_each(docs, size=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    masked = personal_data.mask_documents(docs)
    if "n_chars" in masked.columns:
        counted = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
        masked = masked.withColumn("n_chars", counted)
    return masked


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, and the text decoded from them."""
    ship(spark)
    found = tokenize.encode_and_decode(docs.select("doc_id", "text"))
    return found.withColumnRenamed("decoded", "text")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("pii", mask_personal_data),
    ("sentencepiece", encode_and_decode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
