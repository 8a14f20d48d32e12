"""Exact top-k inner products by a Voronoi kNN join.

Vectors become integers (each component times a factor, floored). A bounded sample of them gives
pivots; queries and data both go to the cell of their nearest pivot. Cells are summarised (count,
radius). From these alone each query cell gets a floor that its queries' k-th scores cannot fall
below, and each data vector a bound on its score with any query of the cell: it is sent only to
cells whose floor it may reach.

Data is dealt to parts of bounded size by row, and the parts are joined in rounds that double: the
first part, the second, the next two, the next four. After each round a query keeps its k best, and
its k-th score is its new floor: the exact floor among all data so far. Later data is held against
it twice, when it is sent (against the least floor of a cell) and when it is solved (against each
query's own), so what a round returns for a query is about its k best of that round's data that
still count. Results thus grow with the logarithm of the data, not with the number of parts. Cells
of many queries are cut into blocks, and each task multiplies its block exactly.

Bounds are computed in doubles and widened by a relative margin; they only decide what is sent.
Scores are exact: where products could pass 2^53, whole numbers of any size are multiplied.

Equal rows of one query id are solved once and carry their number; as in a join, the list of such an
id holds each neighbour that many times.

Defined results: a vector that is NULL, or has a NULL or non-finite component, takes no part, nor
does a row with a NULL id. Missing components of a shorter vector count as 0. Rows that share a
query's id are never its candidates; other repeated rows are candidates each. Scores beyond 64
bits raise an error. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from hardwood.llm.common import map_rows, row_count, sampled
from hardwood.sinks.scratch import keep

MAX_PIVOTS = 64
QUERIES_PER_CELL = 4_000
QUERIES_PER_BLOCK = 2_048
DATA_PER_TASK = 20_000
_MARGIN = 1e-9


def _quantized(df: DataFrame, vec_id: str, vector: str, factor: float) -> DataFrame:
    """vec_id and v: the floored components as doubles, in bytes."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * factor).cast("double"))
    finite = ~F.exists(
        F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    rows = df.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("scaled"))

    def make():
        return lambda part: [[np.array(v, float).tobytes() for v in part.column(1).to_pylist()]]

    return map_rows(rows, make, "v binary", keep=["vec_id"])


def _matrix(values: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for row, value in zip(out, values, strict=True):
        own = np.frombuffer(value, float)
        row[: len(own)] = own
    return out


def _nearest(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore", invalid="ignore"):
        far = (points**2).sum(1)[:, None] - 2 * points @ pivots.T + (pivots**2).sum(1)
        cell = np.nan_to_num(far, nan=np.inf).argmin(1)
        return cell, np.sqrt(((points - pivots[cell]) ** 2).sum(1))


def _choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Spread-out pivots: each next one is the sampled vector farthest from those before, damped."""
    picked, rng = [0], np.random.default_rng(5)
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(picked) < min(count, len(sample)) and far.max() > 0:
        picked.append(int(rng.choice(len(sample), p=far / far.sum())))
        far = np.minimum(far, ((sample - sample[picked[-1]]) ** 2).sum(1))
    return sample[picked]


def _best(scores: np.ndarray, query_ids, data_ids, k: int):
    """(query row, data row) of each query's k best scores, ties to smaller ids."""
    order = np.argsort(data_ids, kind="stable")
    data_ids, scores = data_ids[order], scores[:, order]
    for i, query in enumerate(query_ids):
        own = scores[i]
        allowed = np.flatnonzero(data_ids != query)
        if len(allowed) > k:
            values = own[allowed]
            limit = np.partition(values, len(values) - k)[len(values) - k]
            above = allowed[values > limit]
            allowed = np.append(above, allowed[values == limit][: k - len(above)])
        yield i, data_ids[allowed], own[allowed]


def exact_top_k(
    df: DataFrame, is_query: Column, *, k: int = 20, vec_id: str = "vec_id",
    vector: str = "embedding", factor: float = 64.0, max_pivots: int = MAX_PIVOTS,
    data_per_task: int = DATA_PER_TASK,
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best. ``is_query`` is on ``vec_id``."""
    # The number of a row tells repeated ones apart; it is written, and so the same in all reads.
    rows = _quantized(df, vec_id, vector, factor).withColumn("row", F.monotonically_increasing_id())
    rows = keep(rows, "vectors")
    n_queries, width = row_count(rows.filter(is_query)), rows.agg(F.max(F.length("v"))).first()[0]
    spark = df.sparkSession
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = (width or 0) // 8
    n_rows = row_count(rows)
    n_pivots = max(1, min(max_pivots, n_queries // QUERIES_PER_CELL + 4))
    # Pivots come from a sample of bounded size; they steer the work, not the result.
    drawn = rows.filter(sampled(4096 / n_rows, "row"))
    sample = _matrix([r.v for r in drawn.select("v").collect()] or [rows.first().v], width)
    pivots = _choose_pivots(sample, n_pivots)

    def assigned():
        def compute(part):
            points = _matrix(part.column(1).to_pylist(), width)
            cell, far = _nearest(points, pivots)
            return cell, far, np.sqrt((points**2).sum(1))

        return compute

    celled = keep(map_rows(rows, assigned, "cell int, far double, norm double", rows=4096), "cells")
    data = {r.cell: r for r in celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    queries = celled.filter(is_query).groupBy("vec_id", "v", "cell", "far").agg(
        F.count(F.lit(1)).alias("copies"), F.min("row").alias("query")
    )
    # So many rows may have a query's own id and be none of its candidates.
    own_rows = queries.groupBy("vec_id").agg(F.sum("copies").alias("n")).agg(F.max("n")).first()[0]
    asked = {r.cell: r for r in queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}

    cells = sorted(asked)
    least = {}
    for i in cells:
        # q.x >= p_i.p_j - |p_i| R_j - r_i |p_j| - r_i R_j for every query of i and vector of j
        p, r = pivots[i], asked[i].far
        lows = sorted(
            ((p @ pivots[j] - np.linalg.norm(p) * d.far - r * np.linalg.norm(pivots[j]) - r * d.far, d.n) for j, d in data.items()),
            reverse=True,
        )
        seen, least[i] = 0, -np.inf
        for low, n in lows:
            seen += n
            if seen >= k + own_rows:
                least[i] = low - _MARGIN * (1 + abs(low))
                break
    blocks = {i: -(-asked[i].n // QUERIES_PER_BLOCK) for i in cells}
    n_parts = max(1, -(-n_rows // data_per_task))
    centres, radii = pivots[cells], np.array([asked[i].far for i in cells])
    by_cell = lambda values: F.element_at(F.create_map(*[F.lit(x) for i in cells for x in (i, values[i])]), F.col("cell"))
    own = queries.select(
        "query", F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "copies", "cell",
        F.pmod(F.xxhash64("query"), by_cell(blocks)).cast("int").alias("block"),
        by_cell({i: float(least[i]) for i in cells}).alias("floor"),
    )
    own = keep(own, "queries")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row", F.lit(13)), F.lit(n_parts)).cast("int"))
    best = None
    for low, high in _rounds(n_parts):
        floors = {r.cell: r.floor for r in own.groupBy("cell").agg(F.min("floor").alias("floor")).collect()}
        lowest = np.array([floors[i] for i in cells])

        def needed(lowest=lowest):
            """The query cells that a vector may reach: x.q <= x.p_i + |x| r_i."""

            def compute(part):
                points = _matrix(part.column(1).to_pylist(), width)
                most = points @ centres.T + np.linalg.norm(points, axis=1)[:, None] * radii
                reach = most + _MARGIN * (1 + np.abs(most)) >= lowest
                return [[[cells[j] for j in np.flatnonzero(row)] for row in reach]]

            return compute

        data_of_round = dealt.filter((F.col("part") >= low) & (F.col("part") < high)).select("vec_id", "v", "part")
        sent = map_rows(data_of_round, needed, "to array<int>", rows=4096)
        sent = sent.select("vec_id", "v", "part", F.explode("to").alias("cell"))
        sent = sent.select("*", F.explode(F.sequence(F.lit(0), by_cell(blocks) - 1)).alias("block"))
        asking = own.withColumn("part", F.explode(F.sequence(F.lit(low), F.lit(high - 1))))
        found = asking.groupBy(*_TASK).cogroup(sent.groupBy(*_TASK)).applyInArrow(_solver(k, width), _FOUND)
        best = keep(_k_best(found if best is None else found.unionByName(best), k), "k_best")
        if high < n_parts:
            reached = best.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("k_th"))
            reached = reached.filter(F.col("n") >= k).select(F.col("query").alias("of"), "k_th")
            met = own.join(reached, F.col("query") == F.col("of"), "left")
            floor = F.coalesce(F.greatest("floor", F.col("k_th").cast("double")), F.col("floor"))
            own = keep(met.withColumn("floor", floor).select(*own.columns), "queries")
    # Each distinct query row has at most k rows here; one with copies takes a rank for each.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    last = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = best.withColumn("last", last).withColumn("first", F.col("last") - F.col("copies") + 1)
    ranks = F.explode(F.sequence("first", F.least("last", F.lit(k).cast("long"))))
    ranked = ranked.filter(F.col("first") <= k).select("query_id", ranks.alias("rank"), "vec_id", "score")
    return ranked.withColumn("rank", F.col("rank").cast("int"))


_TASK = ("cell", "block", "part")
_FOUND = "query long, query_id long, vec_id long, score long, copies long"


def _rounds(parts: int) -> Iterator[tuple[int, int]]:
    """Ranges of parts: one, one more, and then as many as there were before."""
    low, high = 0, 1
    while low < parts:
        yield low, min(high, parts)
        low, high = high, 2 * high


def _k_best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query row, ties to smaller ids."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")


def _solver(k: int, width: int):
    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        result = ([], [], [], [], [])
        if left.num_rows and right.num_rows:
            query, query_ids, data_ids = (
                table.column(name).to_numpy()
                for table, name in ((left, "query"), (left, "query_id"), (right, "vec_id"))
            )
            copies, floors = left.column("copies").to_numpy(), left.column("floor").to_numpy()
            q = _matrix(left.column("q").to_pylist(), width)
            x = _matrix(right.column("v").to_pylist(), width)
            if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, width) >= 2.0**53:
                q, x = (np.array([[int(c) for c in row] for row in m], object) for m in (q, x))
            for start in range(0, len(query_ids), 256):
                scores = q[start : start + 256] @ x.T
                for i, ids, values in _best(scores, query_ids[start : start + 256], data_ids, k):
                    # A floor above 2^53 is rounded, so what lies within the margin below it stays.
                    low = floors[start + i] - _MARGIN * (1 + abs(floors[start + i]))
                    still = np.flatnonzero(values.astype(float) >= low)
                    result[0].extend([query[start + i]] * len(still))
                    result[1].extend([query_ids[start + i]] * len(still))
                    result[2].extend(ids[still])
                    result[3].extend(int(v) for v in values[still])
                    result[4].extend([copies[start + i]] * len(still))
        return pa.table([pa.array(c, pa.int64()) for c in result], [f.split()[0] for f in _FOUND.split(", ")])

    return solve
