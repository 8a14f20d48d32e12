"""The whitening solver against dense linear algebra, and the operator against exact arithmetic."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from hardwood.llm import queries, whitening

RNG = np.random.default_rng(4)


def _orthogonal(rows: int, columns: int) -> np.ndarray:
    return np.linalg.qr(RNG.standard_normal((rows, columns)))[0]


def _clustered() -> np.ndarray:
    scale = np.ones(24)
    scale[:5], scale[5:9], scale[12:] = 3, 3 * (1 + 1e-9), 1e-9
    return (_orthogonal(200, 24) * scale) @ _orthogonal(24, 24)


MATRICES = {
    "one": RNG.standard_normal((50, 1)),
    "two": RNG.standard_normal((50, 2)),
    "random": RNG.standard_normal((400, 40)),
    "graded": RNG.standard_normal((400, 40)) * np.logspace(0, -6, 40),
    "graded upwards": RNG.standard_normal((400, 40)) * np.logspace(-6, 0, 40),
    "repeated columns": np.hstack([RNG.standard_normal((400, 12))] * 3),
    "zero columns": np.hstack([RNG.standard_normal((400, 12)), np.zeros((400, 9))]),
    "fewer rows than columns": RNG.standard_normal((9, 40)),
    "identity": np.eye(30),
    "equal values": _orthogonal(300, 30) @ _orthogonal(30, 30),
    "clusters": _clustered(),
    "constant": np.zeros((6, 5)),
}


def _triangle(x: np.ndarray) -> np.ndarray:
    r = np.linalg.qr(x, mode="r")
    return np.pad(r, ((0, x.shape[1] - len(r)), (0, 0)))


@pytest.mark.parametrize("name", MATRICES)
def test_solver_finds_unit_eigenvectors(name):
    x = MATRICES[name]
    axes, values, explained = whitening.solve(_triangle(x), len(x), 16)
    cov = x.T @ x / len(x)
    wanted = np.linalg.svd(x, compute_uv=False)
    rank = np.linalg.matrix_rank(x)
    assert len(values) == min(16, rank)
    if not rank:
        return
    assert np.all(np.diff(values) <= 0)
    singular = np.sqrt(values * len(x))
    np.testing.assert_allclose(singular, wanted[: len(values)], rtol=1e-12, atol=1e-14 * wanted[0])
    np.testing.assert_allclose(explained, values / np.trace(cov), rtol=1e-12)
    assert np.abs(cov @ axes - axes * values).max() < 1e-13 * values[0]
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12


@pytest.mark.parametrize("name", MATRICES)
def test_bidiagonal_form_keeps_the_matrix(name):
    r = _triangle(MATRICES[name])
    a, b, v = whitening.bidiagonal(r)
    form = np.diag(a) + np.diag(b, 1)
    assert (a >= 0).all() and (b >= 0).all()
    np.testing.assert_allclose(v @ form.T @ form @ v.T, r.T @ r, atol=1e-12 * max(1, np.abs(r.T @ r).max()))


def test_dqds_is_accurate_for_each_value():
    # A graded bidiagonal matrix whose smallest values a plain eigenvalue routine loses.
    a, b = np.logspace(0, -12, 25), np.logspace(-1, -12, 24)
    values = whitening.dqds((a**2).tolist(), (b**2).tolist())
    # The product of all eigenvalues is that of the squared diagonal, to full relative precision.
    assert math.isclose(math.prod(v / s for v, s in zip(values, a**2, strict=True)), 1, rel_tol=1e-12)
    assert whitening.dqds([0.0, 0.0], [0.0]) == [0, 0] and whitening.dqds([], []) == []


def _brute_force(vectors: dict, components: int = 16):
    """Exact integers and a dense eigensolver, over {row: vector}."""
    whole = {i: v for i, v in vectors.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    width = max((len(v) for v in whole.values()), default=0)
    x = {i: tuple([math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v))) for i, v in whole.items()}
    listed = sorted(set(x.values()))
    n, sums = len(listed), [sum(c) for c in zip(*listed, strict=True)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)] for v in listed])
    cov = centred.T @ centred / max(1, n)
    values, axes = np.linalg.eigh(cov)
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in x.items()}
    place = {v: k for k, v in enumerate(listed)}
    return n, deviation, values[::-1][:components], axes[:, ::-1][:, :components], centred, {i: place[v] for i, v in x.items()}


def _check(rows, vectors):
    n, deviation, values, axes, centred, place = _brute_force(vectors)
    k = max(r.component for r in rows)
    assert len(rows) == k * len(deviation) and {r.component for r in rows} == set(range(1, k + 1))
    found = {(r.vec_id, r.component): r for r in rows}
    white = np.zeros((len(centred), k))
    for (i, c), r in found.items():
        assert (r.n, int(r.deviation)) == (n, deviation[i])
        assert math.isclose(r.explained, values[c - 1] / (centred**2).sum() * n, rel_tol=1e-9)
        white[place[i], c - 1] = r.whitened
    cov = (white - white.mean(axis=0)).T @ (white - white.mean(axis=0)) / n
    assert np.abs(cov - np.eye(k)).max() < 1e-9
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    for c in range(k):
        gap = np.abs(np.delete(values, c) - values[c]).min(initial=np.inf) / values[0]
        if gap > 1e-6:
            plain = centred @ axes[:, c] / math.sqrt(values[c])
            assert min(np.abs(plain - s * white[:, c]).max() for s in (1, -1)) < 1e-7


def test_query_matches_dense_linear_algebra(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in table.collect()}
    rows = queries.queries()["op11_embedding_whitening"](spark, sf_dir).collect()
    assert max(r.component for r in rows) == 16
    _check(rows, vectors)


def test_odd_vectors(spark):
    data = [
        (1, [1.0, 2.0, 0.5], "a"), (2, None, "b"), (3, [1.0, None, 2.0], None), (4, [float("nan")] * 3, "c"),
        (5, [float("inf"), 0.0, 0.0], "c"), (6, [], "d"), (7, [0.0, 0.0], "d"), (8, [-3.0, 4.0, 1.0, 9.5], "e"),
        (8, [2.0, 2.0, 2.0], "e"), (None, [5.0, -1.0, 7.0], "f"), (10, [1.0, 2.0, 0.5], "f"), (11, [1e9, 0.1, 1.0], "g"),
    ]
    odd = spark.createDataFrame(data, "vec_id long, embedding array<double>, x string").selectExpr(
        "*", "1 AS component", "2 AS n", "'q' AS entries", "true AS whole", "0 AS deviation"
    )
    rows = whitening.whiten(odd.repartition(5)).collect()
    vectors = {i: v for i, (_, v, _) in enumerate(data)}
    n, deviation, values, *_ = _brute_force(vectors)
    assert {r.n for r in rows} == {n} and n == 6
    k = max(r.component for r in rows)
    assert sorted(int(r.deviation) for r in rows) == sorted(d for d in deviation.values() for _ in range(k))
    assert sum(r.vec_id == 8 for r in rows) == 2 * k and sum(r.vec_id is None for r in rows) == k
    one = {r.component: r.whitened for r in rows if r.vec_id == 1}
    assert one == {r.component: r.whitened for r in rows if r.vec_id == 10}
    assert {r.identity_error < 1e-9 for r in rows} == {True}

    assert whitening.whiten(odd.limit(0)).collect() == []
    assert whitening.whiten(odd.filter("vec_id in (1, 10)")).collect() == []
    with pytest.raises(Exception, match="2\\^53"):
        whitening.whiten(spark.createDataFrame([(1, [1e18]), (2, [0.0])], "vec_id long, embedding array<double>")).collect()


def test_deviations_beyond_64_bits_stay_exact(spark):
    data = [(i, [float((i * 7919 + j) % 97) * 2.0**38 for j in range(3)]) for i in range(40)]
    rows = whitening.whiten(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert max(int(r.deviation) for r in rows) > 1 << 63
    _check(rows, dict(data))


def test_triangles_of_many_tasks_give_one(spark):
    data = [(i, [float(c) for c in RNG.integers(-9, 9, 6)]) for i in range(300)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    vectors = whitening.integer_vectors(df, "vec_id", "embedding", 64.0).select("x").repartition(150)
    n, sums = whitening._totals(vectors)
    r = whitening.triangle(vectors, n, sums)
    x = np.array([[64 * c for c in v] for _, v in data]) - np.array(sums) / n
    np.testing.assert_allclose(r.T @ r, x.T @ x, rtol=1e-10, atol=1e-6)
