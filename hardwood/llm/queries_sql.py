"""Expected results of the text queries that SQL can express, for DuckDB."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUP = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
  END)) AS s FROM words
), reps AS (
  SELECT s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY s
), items AS (
  SELECT rep, len(s) AS n, unnest(s) AS x FROM reps
), pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.x = b.x AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT rep AS a, rep AS b FROM reps
  UNION
  SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), roots AS (
  SELECT a AS rep, min(b) AS root FROM reach GROUP BY a
)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id,
       doc_id = coalesce(root, doc_id) AS kept
FROM sets LEFT JOIN reps ON sets.s = reps.s LEFT JOIN roots ON reps.rep = roots.rep
"""

KNN = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""

_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAINED = rf"""
WITH items AS (
  SELECT item_id, row_number() OVER () AS row, {_WORDS} AS w FROM benchmark
  WHERE item_id IS NOT NULL AND text IS NOT NULL
), sized AS (
  SELECT item_id, row, w, least(5, len(w)) AS k FROM items WHERE len(w) > 0
), item_sets AS (
  SELECT item_id, row, k, list_distinct(list_transform(range(1, len(w) - k + 2),
    lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s FROM sized
), item_shingles AS (
  SELECT item_id, row, k, len(s) AS n, unnest(s) AS x FROM item_sets
), docs AS (
  SELECT row_number() OVER () AS doc, doc_id, {_WORDS} AS w FROM documents
), doc_shingles AS (
  SELECT DISTINCT doc, doc_id, k, unnest(list_transform(range(1, len(w) - k + 2),
    lambda i: array_to_string(w[i : i + k - 1], ' '))) AS x
  FROM docs, (SELECT DISTINCT k FROM sized)
)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_shingles, count(*) AS n_shared
FROM item_shingles JOIN doc_shingles USING (k, x)
GROUP BY doc, doc_id, item_id, row, n HAVING 100 * count(*) >= 80 * n
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash_near_dup": NEAR_DUP, "op3_voronoi_knn": KNN, "op5_decontamination": CONTAINED}
