"""SimHash fingerprints and components against brute force."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hardwood.llm import queries, simhash


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """The smallest id reachable over links, for (id, fingerprint) rows; ids may repeat."""
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    prints = np.array([f for i, f in rows if i is not None], np.uint64)
    own = [i for i, _ in rows if i is not None]
    for k, x in enumerate(prints):
        for other in np.flatnonzero(np.bitwise_count(prints[k + 1 :] ^ x) <= 3):
            a, b = sorted((top(own[k]), top(own[k + 1 + other])))
            root[b] = a
    return {i: top(i) for i in ids}


def test_query_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.queries()["op12_simhash_near_dup"](spark, sf_dir).collect()
    prints = [(d.doc_id, plain_fingerprint(d.text)) for d in docs]
    assert sorted((r.doc_id, r.fingerprint) for r in rows) == sorted((i, f"{f:016x}") for i, f in prints)
    wanted = components(prints)
    assert {r.doc_id: r.component_id for r in rows} == wanted and len(set(wanted.values())) < len(rows)


@pytest.fixture(scope="module")
def balls(spark):
    """Fingerprints in a few dense groups, where most differ in bits of one half, and scattered ones."""
    rng = np.random.default_rng(8)
    prints = []
    for centre in rng.integers(0, 1 << 63, 4, dtype=np.uint64):
        places = rng.choice(64, 11, replace=False)
        for _ in range(250):
            chosen = rng.choice(places, rng.integers(0, 7), replace=False)
            prints.append(int(centre) ^ sum(1 << int(p) for p in chosen))
    for centre in rng.integers(0, 1 << 63, 300, dtype=np.uint64):
        prints.append(int(centre))
        prints.append(int(centre) ^ sum(1 << int(p) for p in rng.choice(64, rng.integers(1, 6), replace=False)))
    # One half is the same for many, the other is far apart.
    prints += [int(low) for low in rng.integers(0, 1 << 32, 300)]
    distinct = sorted(set(prints))
    ids = rng.permutation(10 * len(distinct))[: len(distinct)].tolist()
    rows = list(zip(ids, distinct, strict=True))
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in rows]
    return rows, spark.createDataFrame(signed, "rep long, fp long")


@pytest.mark.parametrize("bucket_rows", [4096, 64, 8])
def test_links_of_crowded_groups_match_brute_force(balls, bucket_rows):
    rows, table = balls
    links = simhash._links(table, bucket_rows)
    found = {r.id: r.root for r in simhash.smallest_reachable(links).collect()}
    wanted = components(rows)
    assert {i: found.get(i, i) for i in wanted} == wanted
    assert links.count() < 70 * len(rows)


def test_no_plan_holds_a_cross_join(balls):
    _, table = balls
    plan = simhash._links(table, 8)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_odd_rows(spark):
    long = "alpha beta gamma delta " * 6000
    data = [
        (7, None), (3, ""), (9, " \t\n"), (4, "One two"), (5, "one TWO"), (None, "one two"), (1, long), (2, long),
        (8, "x y z w"), (8, "one two"), (8, "one two"), (6, "É é"), (10, "é é"),
    ]
    odd = spark.createDataFrame(data, "doc_id long, text string").selectExpr(
        "*", "1 AS fp", "2 AS rep", "'c' AS component_id", "3 AS copies"
    )
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(data)
    prints = [(i, plain_fingerprint(t)) for i, t in data]
    assert sorted((r.doc_id or 0, r.fp % (1 << 64)) for r in rows) == sorted((i or 0, f) for i, f in prints)
    wanted = components(prints)
    # Rows of one id are one node: 4, 5 and 8 meet through the second text of 8.
    assert {r.doc_id: r.component_id for r in rows} == wanted | {None: None}
    assert wanted[9] == 3 and wanted[5] == 4 and wanted[8] == 4 and wanted[2] == 1
    assert simhash.near_duplicates(odd.limit(0)).collect() == []


def test_an_id_with_two_texts_ties_their_groups(spark):
    data = [(5, "a b c d"), (9, "a b c d"), (9, "p q r s"), (2, "p q r s"), (7, "p q r s")]
    rows = simhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {r.component_id for r in rows} == {2}


def test_native_hash_agrees(spark, sf_dir):
    """The engine's own hash of a short text (one shingle) is its fingerprint."""
    docs = spark.createDataFrame([(1, "one two three"), (2, "é"), (3, "x y")], "doc_id long, text string")
    rows = simhash.near_duplicates(docs).join(docs, "doc_id").select("fp", F.xxhash64("text").alias("h")).collect()
    assert all(r.fp == r.h for r in rows)
