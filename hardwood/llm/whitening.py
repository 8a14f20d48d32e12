"""Whitening directions of embedding vectors by a bidiagonal qd solver.

Vectors become integers (each component times a factor, floored, plus an offset). The fit list
holds each distinct integer vector once.

1. *Exact centring.* n and the sums S per dimension are exact integers, and so is n*x - S; a centred
   row is that divided by n, rounded once.
2. *Blockwise QR.* Each task keeps one triangle R of the centred rows it has seen; the tasks'
   triangles are reduced in a tree of bounded fan-in, so nothing that grows with the rows meets in
   one place. The last R (dimension x dimension) goes to the driver. R'R is n times the covariance.
3. *Bidiagonal form.* Householder reflections from both sides make R upper bidiagonal.
4. *dqds* finds all squared singular values from the squares of the bidiagonal entries, without
   subtractions but for the shift. The shift is the reciprocal of the trace of the inverse, a lower
   bound of the smallest eigenvalue that a recursion of positive terms gives.
5. *Twisted factorisations* of the shifted matrix, from the top and from the bottom, joined where
   their pivot is smallest, give each direction by products alone. Directions of values that lie
   close together are made orthogonal; where one is lost in that, inverse iteration through the same
   factors finds it anew.

Defined results: rows whose vector is NULL or holds a NULL or non-finite entry are left out. Missing
components of a shorter vector count as 0, so an empty vector is all zero. Rows that repeat a vector,
or have a NULL id, each get their result. Directions whose eigenvalue is zero to working precision
have no whitened value and are left out: fewer vectors than dimensions give fewer components, and one
distinct vector, or an empty table, gives no row. Ties in value are numbered in either order. Entries
whose scaled value reaches 2^53, and deviations beyond 38 digits, raise an error. Of the input only
the id is carried, so extra columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import fold_rows, map_rows
from hardwood.sinks.scratch import keep

EPS = np.finfo(float).eps
#: Values of the working set of one task, in doubles.
BLOCK_VALUES = 1 << 20


# ---- integer vectors

def _pack(values: np.ndarray) -> bytes:
    """An integer vector without trailing zeros in the narrowest of three widths, which is its first byte."""
    filled = np.flatnonzero(values)
    values = values[: filled[-1] + 1] if len(filled) else values[:0]
    most = np.abs(values).max(initial=0)
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return bytes([width]) + values.astype(f"<i{width}").tobytes()


def _unpack(packed: list[bytes], width: int) -> np.ndarray:
    """Packed vectors as rows of ``width`` integers."""
    if len({(len(p), p[0]) for p in packed}) == 1:
        size = packed[0][0]
        rows = np.frombuffer(b"".join([p[1:] for p in packed]), f"<i{size}").astype(np.int64)
        rows = rows.reshape(len(packed), -1)
        return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    out = np.zeros((len(packed), width), np.int64)
    for row, p in zip(out, packed, strict=True):
        own = np.frombuffer(p, f"<i{p[0]}", offset=1)
        row[: len(own)] = own
    return out


def integer_vectors(df: DataFrame, vec_id: str, vector: str, factor: float) -> DataFrame:
    """vec_id and x: the floored, scaled components of every row that takes part, packed."""
    entries = F.col(vector).cast("array<double>")
    odd = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(F.col(vec_id).alias("vec_id"), entries.alias("entries"), (~odd).alias("whole"))
    rows = rows.filter(F.coalesce("whole", F.lit(False))).select("vec_id", "entries")

    def make():
        def compute(part):
            entries = part.column(1)
            flat = np.floor(entries.flatten().to_numpy(zero_copy_only=False) * factor)
            if np.abs(flat).max(initial=0) >= 2.0**53:
                raise ValueError("a scaled component reaches 2^53")
            ends = np.cumsum(entries.value_lengths().to_numpy(zero_copy_only=False))
            return [[_pack(row) for row in np.split(flat.astype(np.int64), ends[:-1])] if len(ends) else []]

        return compute

    return map_rows(rows, make, "x binary", keep=["vec_id"], rows=4096)


def _slice_rows(dimensions: int) -> int:
    return max(1, BLOCK_VALUES // max(1, dimensions))


def _totals(distinct: DataFrame) -> tuple[int, list[int]]:
    """The rows of the fit list and the exact sum of each dimension; one row per dimension is collected."""

    def add(parts: Iterator[pa.RecordBatch]):
        n, sums = 0, []
        for part in parts:
            packed = part.column(0).to_pylist()
            rows = _unpack(packed, max((len(p) - 1) // p[0] for p in packed))
            wide = np.abs(rows).max(initial=0) * len(rows) >= 1 << 62
            own = (rows.astype(object) if wide else rows).sum(axis=0).tolist()
            sums += [0] * (len(own) - len(sums))
            for i, value in enumerate(own):
                sums[i] += value
            n += len(packed)
        # Dimension -1 carries the count.
        yield [-1, *range(len(sums))], [n, *sums]

    found = fold_rows(distinct, add, "dimension int, total decimal(38,0)").groupBy("dimension")
    totals = {r.dimension: int(r.total) for r in found.agg(F.sum("total").alias("total")).collect()}
    return totals.get(-1, 0), [totals[i] for i in range(len(totals) - 1)]


def _deviations(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exactly. The offset of x cancels."""
    most = n * int(np.abs(rows).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 1 << 62:
        return n * rows - np.array(sums, np.int64)
    return n * rows.astype(object) - np.array(sums, object)


def _squares(deviations: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    most = int(np.abs(deviations).max(initial=0)) if deviations.size else 0
    if deviations.dtype != object and most**2 * max(1, deviations.shape[1]) >= 1 << 63:
        deviations = deviations.astype(object)
    return (deviations**2).sum(axis=1).tolist()


# ---- blockwise QR

def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def triangle(distinct: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows of the fit list, reduced block by block and then in a tree."""
    d = len(sums)

    def reduce(parts: Iterator[pa.RecordBatch]):
        r = np.empty((0, d))
        for part in parts:
            centred = _deviations(_unpack(part.column(0).to_pylist(), d), n, sums).astype(float) / n
            r = _triangle(np.vstack([r, centred]))
        if len(r):
            yield [TaskContext.get().partitionId()], [r.tobytes()]

    fan_in = max(2, min(64, BLOCK_VALUES // (d * d)))

    def merge(group: pa.Table) -> pa.Table:
        r = np.empty((0, d))
        for packed in group.column("r").to_pylist():
            r = _triangle(np.vstack([r, np.frombuffer(packed).reshape(-1, d)]))
        return pa.table({"node": group.column("node")[:1].cast(pa.int32()), "r": [r.tobytes()]})

    schema = "node int, r binary"
    level = keep(fold_rows(distinct, reduce, schema, _slice_rows(d)), "triangles")
    while (nodes := level.agg(F.max("node")).first()[0]) is not None and nodes > 0:
        parents = level.withColumn("node", F.expr(f"node div {fan_in}").cast("int"))
        level = keep(parents.groupBy("node").applyInArrow(merge, schema), "triangles")
    found = level.collect()
    r = np.frombuffer(found[0].r).reshape(-1, d) if found else np.empty((0, d))
    return np.pad(r, ((0, d - len(r)), (0, 0)))


# ---- bidiagonal form

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal (neither negative) of Q'RV, and V."""
    a = np.array(r, float)
    d = len(a)
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.abs(x).max(initial=0)
        if len(x) < 2 or not np.abs(x[1:]).max() > 0:
            return None
        w = x / size
        w[0] += math.copysign(np.linalg.norm(w), w[0])
        return w / np.linalg.norm(w)

    for k in range(d):
        if (w := reflector(a[k:, k].copy())) is not None:
            a[k:, k:] -= np.outer(2 * w, w @ a[k:, k:])
        if (w := reflector(a[k, k + 1 :].copy())) is not None:
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ w, 2 * w)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, 2 * w)
    diagonal, above = np.diag(a).copy(), np.diag(a, 1).copy()
    # Signs move into V: those of rows into the (unused) left side, those of columns into the right.
    column = np.ones(d)
    for k in range(d - 1):
        row = math.copysign(1, diagonal[k]) * column[k]
        column[k + 1] = math.copysign(1, above[k]) * row
    return np.abs(diagonal), np.abs(above), v * column


# ---- dqds

def _two(q: list[float], e: float) -> tuple[float, float]:
    """Both eigenvalues of a block of two."""
    high, low = max(q), min(q)
    t = 0.5 * ((high - low) + e)
    if e > low * (10 * EPS) ** 2 and t > 0:
        s = low * (e / t)
        s = low * (e / (t * (1 + math.sqrt(1 + s / t)))) if s <= t else low * (e / (t + math.sqrt(t) * math.sqrt(t + s)))
        t = high + (s + e)
        high, low = t, low * (high / t)
    return high, low


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds step, or None when the shift exceeds the smallest eigenvalue."""
    new_q, new_e = [], []
    d = q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return None
        total = d + e[k]
        new_q.append(total)
        ratio = q[k + 1] / total if total > 0 else 0.0
        new_e.append(e[k] * ratio)
        d = (d * ratio if total > 0 else q[k + 1]) - shift
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e


def _below(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest eigenvalue: the reciprocal of the trace of the inverse."""
    if min(q) <= 0:
        return 0.0
    own = total = 1 / q[0]
    for k in range(len(e)):
        own = (1 + e[k] * own) / q[k + 1]
        total += own
    return (1 - 8 * len(q) * EPS) / total if math.isfinite(total) else 0.0


def dqds(q: list[float], e: list[float]) -> list[float]:
    """All eigenvalues of B'B in falling order, from the squares of B's diagonal and superdiagonal."""
    scale = max([*q, *e], default=0.0)
    if scale == 0:
        return [0.0] * len(q)
    found: list[float] = []
    blocks = [([x / scale for x in q], [x / scale for x in e], 0.0)]
    tolerance = (10 * EPS) ** 2
    while blocks:
        q, e, sigma = blocks.pop()
        lost = 0.0  # low part of the sum of shifts
        for _ in range(200 * len(q) + 200):
            while len(q) > 2 and e[-1] <= tolerance * (sigma + q[-1]):
                found.append(sigma + (q.pop() + lost))
                e.pop()
            if len(q) <= 2:
                break
            split = next((k for k in range(len(e) - 1) if e[k] <= tolerance * sigma or e[k] == 0), None)
            if split is not None:
                blocks.append((q[: split + 1], e[:split], sigma + lost))
                q, e = q[split + 1 :], e[split + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            shift = _below(q, e)
            while (step := _transform(q, e, shift)) is None:
                shift = shift / 2 if shift > EPS * sigma else 0.0
            q, e = step
            total = sigma + shift
            lost += shift - (total - sigma)
            sigma = total
        else:
            raise ArithmeticError("dqds did not converge")
        ends = _two(q, e[0]) if len(q) == 2 else q
        found.extend(sigma + (x + lost) for x in ends)
    return sorted((x * scale for x in found), reverse=True)


# ---- twisted factorisations

class Twisted:
    """B'B - value = N G N' with N lower bidiagonal above row ``k`` and upper bidiagonal below it."""

    def __init__(self, a: list[float], b: list[float], value: float, smallest: float):
        n = len(a)
        ratio = [y / x for x, y in zip(a, b, strict=False)]
        apart = lambda x: x if abs(x) > smallest else -smallest
        down, top, s = [0.0] * n, [0.0] * n, [0.0] * n
        s[0] = -value
        for i in range(n):
            top[i] = apart(a[i] * a[i] + s[i])
            if i < n - 1:
                down[i] = a[i] * b[i] / top[i]
                s[i + 1] = down[i] * ratio[i] * s[i] - value
        up, bottom, p = [0.0] * n, [0.0] * n, [0.0] * n
        p[n - 1] = a[n - 1] * a[n - 1] - value
        for i in range(n - 2, -1, -1):
            bottom[i + 1] = apart(b[i] * b[i] + p[i + 1])
            t = a[i] * a[i] / bottom[i + 1]
            up[i] = ratio[i] * t
            p[i] = p[i + 1] * t - value
        bottom[0] = p[0]
        twists = [s[i] + (p[i] + value) for i in range(n)]
        self.k = min(range(n), key=lambda i: abs(twists[i]))
        self.gamma, self.down, self.up = twists[self.k], down, up
        self.pivots = [*top[: self.k], apart(self.gamma), *bottom[self.k + 1 :]]

    def _outward(self, x: list[float]) -> np.ndarray:
        """Solve N'z = x."""
        x = list(x)
        for i in range(self.k - 1, -1, -1):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(self.k, len(x) - 1):
            x[i + 1] -= self.up[i] * x[i]
        return np.array(x)

    def vector(self) -> np.ndarray:
        start = [0.0] * len(self.pivots)
        start[self.k] = 1.0
        return self._outward(start)

    def solve(self, y: np.ndarray) -> np.ndarray:
        y = y.tolist()
        for i in range(self.k):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(y) - 1, self.k, -1):
            y[i - 1] -= self.up[i - 1] * y[i]
        return self._outward([x / g for x, g in zip(y, self.pivots, strict=True)])


def directions(a: np.ndarray, b: np.ndarray, values: list[float]) -> np.ndarray:
    """Unit eigenvectors (columns) of B'B for the largest ``values``, in falling order."""
    n, largest = len(a), max(values)
    # A zero on the diagonal is moved by less than the rounding of the reduction.
    a = np.maximum(a, EPS * EPS * math.sqrt(largest)).tolist()
    b, rng = b.tolist(), np.random.default_rng(11)
    smallest = EPS * EPS * largest
    out: list[np.ndarray] = []

    def apart(z: np.ndarray, close: list[np.ndarray]) -> np.ndarray:
        for _ in range(2):
            for other in close:
                z = z - other * (other @ z)
        return z

    for i, value in enumerate(values):
        factors = Twisted(a, b, value, smallest)
        z = factors.vector()
        for _ in range(3):
            # The Rayleigh quotient of z differs from the value by this.
            change = factors.gamma / (z @ z)
            if not abs(change) > 4 * EPS * value:
                break
            refined = Twisted(a, b, value + change, smallest)
            other = refined.vector()
            if abs(refined.gamma) / (other @ other) >= abs(change):
                break
            value, factors, z = value + change, refined, other
        z = z / np.linalg.norm(z)
        close = [out[j] for j in range(i) if abs(values[j] - values[i]) <= 0.1 * largest]
        z = apart(z, close)
        if np.linalg.norm(z) < 0.5:
            z = apart(rng.standard_normal(n), close)
            for _ in range(5):
                z = apart(factors.solve(z / np.linalg.norm(z)), close)
                z /= np.abs(z).max()
        out.append(z / np.linalg.norm(z))
    return np.array(out).T.reshape(n, len(values))


# ---- the model

@dataclass(frozen=True)
class Whitening:
    """n and sums of the fit list, unit directions (columns), their eigenvalues and shares of the trace."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(float) / self.n) @ (self.axes / np.sqrt(self.values))


def solve(r: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions, eigenvalues and explained shares of R'R/n, largest first, zero ones left out."""
    diagonal, above, v = bidiagonal(r)
    squares = dqds((diagonal**2).tolist(), (above**2).tolist())
    floor = squares[0] * (len(squares) * EPS) ** 2 * 16 if squares else 0
    chosen = [x for x in squares[:components] if x > floor]
    if not chosen:
        return np.empty((len(r), 0)), np.empty(0), np.empty(0)
    axes = v @ directions(diagonal, above, chosen)
    # Either sign will do; the largest entry is made positive.
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return axes, np.array(chosen) / n, np.array(chosen) / math.fsum(squares)


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened fit list minus the identity."""
    k = len(model.values)
    shared = distinct.sparkSession.sparkContext.broadcast(model)

    def add(parts: Iterator[pa.RecordBatch]):
        own, total = shared.value, np.zeros((k + 1, k))
        for part in parts:
            rows = _unpack(part.column(0).to_pylist(), len(own.sums))
            white = own.whitened(_deviations(rows, own.n, own.sums))
            total += np.vstack([white.T @ white, white.sum(axis=0)])
        yield range(total.size), total.ravel()

    found = fold_rows(distinct, add, "cell int, total double", _slice_rows(len(model.sums)))
    cells = {r.cell: r.total for r in found.groupBy("cell").agg(F.sum("total").alias("total")).collect()}
    total = np.array([cells[i] for i in range((k + 1) * k)]).reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def fit(vectors: DataFrame, components: int = 16) -> Whitening | None:
    """The whitening of :func:`integer_vectors`, each distinct one counted once; None without any direction."""
    distinct = keep(vectors.select("x").distinct(), "fit_list")
    n, sums = _totals(distinct)
    if not n or not sums:
        return None
    axes, values, explained = solve(triangle(distinct, n, sums), n, components)
    if not len(values):
        return None
    model = Whitening(n, sums, axes, values, explained)
    return Whitening(n, sums, axes, values, explained, _identity_error(distinct, model))


def whiten(
    df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", factor: float = 64.0,
    components: int = 16,
) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error per row and component."""
    vectors = keep(integer_vectors(df, vec_id, vector, factor), "integer_vectors")
    model = fit(vectors, components)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    shared, k = df.sparkSession.sparkContext.broadcast(model), len(model.values)

    def project(parts: Iterator[pa.RecordBatch]):
        own = shared.value
        for part in parts:
            rows = part.num_rows
            deviations = _deviations(_unpack(part.column(1).to_pylist(), len(own.sums)), own.n, own.sums)
            squares = pa.array(_squares(deviations), pa.decimal128(38, 0))
            each = np.repeat(np.arange(rows), k)
            yield (
                part.column(0).take(each), np.tile(np.arange(1, k + 1), rows), np.full(rows * k, own.n),
                squares.take(each), own.whitened(deviations).ravel(),
                np.tile(own.explained, rows), np.full(rows * k, own.identity_error),
            )

    return fold_rows(vectors, project, schema, max(1, _slice_rows(len(model.sums) + 8 * k)))
