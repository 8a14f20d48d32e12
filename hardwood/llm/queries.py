"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm import (
    decontaminate,
    html_text,
    language,
    licenses,
    near_dup,
    personal_data,
    sharding,
    simhash,
    spelling,
    tokenize,
    toxicity,
    voronoi_knn,
    whitening,
)
from hardwood.llm.common import folds, ship, table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), teaches=toxicity.taught())
    return toxicity.score_documents(docs, model).select(
        "doc_id", (folds("doc_id", 5) == 0).alias("held_out"), "score", "predicted",
        F.size("passages").cast("long").alias("n_passages"),
    )


def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_documents(spark, sf_dir), size=3, percent=85)


def op3_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return voronoi_knn.exact_top_k(vectors, F.col("vec_id") % 20 == 0, k=20, factor=64.0)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    pairs = found.select("doc_id", F.explode("items").alias("item"))
    return pairs.select("doc_id", "item.item_id", "item.n_shingles", "item.n_shared")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_spans(_documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_documents(spark, sf_dir), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, teaches=language.taught())
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (folds("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.token_digests(_documents(spark, sf_dir))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    white = whitening.whiten(vectors, factor=64.0, components=16)
    # Beyond 64 bits the cast raises; the operator's own deviation has 38 digits.
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op12_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir), size=3)
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, sf_dir), every=97).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )


QUERIES = (
    op1_toxicity, op2_minhash_near_dup, op3_voronoi_knn, op4_html_extraction, op5_decontamination,
    op6_license_scan, op7_pii, op8_sharding, op9_language_id, op10_sentencepiece,
    op11_embedding_whitening, op12_simhash_near_dup, op13_spelling_variants,
)


def _shipped(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _shipped(query) for query in QUERIES}
