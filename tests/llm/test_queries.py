"""The registered text queries: those with SQL against it, the pipeline against plain Python."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hardwood.llm import decontaminate, near_dup, personal_data, queries, queries_sql
from hardwood.llm.common import WordHashes, shingle_set
from tests.compare import assert_same, connect

EXPECTED = queries_sql.oracle_sql()


@pytest.mark.parametrize("key", EXPECTED)
def test_matches_expected(spark, sf_dir, key):
    with connect(sf_dir) as connection:
        assert assert_same(queries.queries()[key](spark, sf_dir), connection, EXPECTED[key]) > 0


#: Queries whose whole results other tests compare with brute force.
OTHER = {"op4_html_extraction", "op11_embedding_whitening", "op12_simhash_near_dup", "op13_spelling_variants"}


@pytest.mark.parametrize("key", [k for k in queries.queries() if k not in EXPECTED and k not in OTHER])
def test_returns_a_row_per_row(spark, sf_dir, key):
    rows = queries.queries()[key](spark, sf_dir).count()
    assert rows == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_pipeline_stages_match_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    kept = by_name["toxicity"](spark, docs, sf_dir)
    assert kept.columns == docs.columns and 0.8 < kept.count() / docs.count() < 1

    once = by_name["minhash_near_dedup"](spark, kept, sf_dir)
    rows = {r.doc_id: r.text for r in kept.collect()}
    hasher = WordHashes()
    ids = np.array(sorted(rows))
    sets = [shingle_set(hasher.of(near_dup.words_of(rows[i])), 5) for i in ids]
    roots = near_dup.linked_components(ids, sets, 80)
    stays = {int(i) for i, r, s in zip(ids, roots, sets, strict=True) if r == i or not len(s)}
    assert {r.doc_id for r in once.collect()} == stays

    clean = by_name["benchmark_decontamination"](spark, once, sf_dir)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    flat = {i: " " + " ".join(w.decode() for w in decontaminate.words_of(rows[i])) + " " for i in stays}
    leaks = {i for i, t in flat.items() for b in items if " " + " ".join(w.decode() for w in decontaminate.words_of(b.text)) + " " in t}
    left = {r.doc_id for r in clean.collect()}
    assert leaks and not leaks & left and len(stays - left) <= len(leaks) + 2

    masked = by_name["pii"](spark, clean, sf_dir)
    for r in masked.collect():
        assert not personal_data.base_spans(r.text) and r.n_chars == len(r.text)
    tokens = by_name["sentencepiece"](spark, masked, sf_dir)
    assert {(r.doc_id, r.text) for r in tokens.collect()} == {(r.doc_id, r.text) for r in masked.collect()}


def test_pipeline_on_odd_rows(spark, sf_dir, tmp_path):
    data = [(1, None, "en", "s", None, "k"), (2, "", None, None, 0, "k"), (None, "no id", "en", "s", 5, "k"),
            (3, "one two three four five six", "en", "s", 27, "k"), (3, "one two three four five six", "en", "s", 27, "k")]
    odd = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, items string")
    for frame, rows in ((odd, 4), (odd.limit(0), 0)):
        out = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, sf_dir)
            assert out.columns == frame.columns or name == "sentencepiece"
        assert out.count() == rows


def test_pipeline_carries_columns_of_any_name(spark, sf_dir):
    """Names that the stages use, or used, for columns of their own."""
    names = ["_id", "_kept", "_toxic", "_contained", "_items_0", "id", "kept", "toxic", "contained", "row", "copies", "Label", "score"]
    few = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 120")
    docs = few.withColumns({name: F.concat(F.lit(f"{name} "), F.col("doc_id")) for name in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == few.columns + names
    rows = docs.collect()
    assert len(rows) > 60 and all(r[name] == f"{name} {r.doc_id}" for r in rows for name in names)
