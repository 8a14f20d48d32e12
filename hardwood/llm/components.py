"""Connected components of an edge table, by alternating large and small stars.

Every round is a grouping over edges that no task holds whole; hot nodes are pre-aggregated by
their minimum, and what is found of them is broadcast instead of gathering their edges in one task.
Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import row_count
from hardwood.sinks.scratch import keep

# A key is heavy when it holds more than one in so many rows; there are fewer heavy keys than this.
HEAVY_SHARE = 1000


def join_counted(rows: DataFrame, facts: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` joined with ``facts``, one row per key that counts its rows in column ``count``.

    ``total`` is the sum of all counts. Facts of heavy keys, fewer than ``HEAVY_SHARE``, are
    broadcast, so that the rows of one key never meet in a task; the other keys are shuffled.
    """
    heavy = F.col(count) * HEAVY_SHARE > total
    spread = rows.join(F.broadcast(facts.filter(heavy)), key)
    others = rows.join(F.broadcast(facts.filter(heavy).select(key)), key, "left_anti")
    return spread.unionByName(others.join(facts.filter(~heavy), key))


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Point neighbours at the smallest id around a node: the larger ones, or the smaller ones."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(
            F.least(F.min("b"), F.col("a")).alias("low"), F.count(F.lit(1)).alias("degree")
        )
        met = join_counted(both.filter("b > a"), lowest, "a", "degree", 2 * total)
        moved = met.select(F.col("low").alias("a"), "b")
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("degree"))
        met = join_counted(down, lowest, "a", "degree", total)
        moved = met.select(F.col("low").alias("a"), "b")
        moved = moved.unionByName(lowest.select(F.col("low").alias("a"), F.col("a").alias("b")))
    return moved.filter("a <> b").distinct()


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """``id`` and ``root`` (the smallest id it reaches) of every node of edges (a, b).

    Nodes without an edge, and edges from a node to itself, give no row; an empty table gives none.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = keep(edges.select(low.alias("a"), high.alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        # All stars: no node that is a centre is also a leaf, and every leaf has one centre.
        leaves = now.groupBy("b").agg(F.count(F.lit(1)).alias("centres"))
        mixed = leaves.join(now.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if leaves.filter("centres > 1").isEmpty() and mixed.isEmpty():
            break
        met = keep(_star(now, large=True, total=row_count(now)), "edges")
        now = keep(_star(met, large=False, total=row_count(met)), "edges")
    centres = now.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct()
    return now.select(F.col("b").alias("id"), F.col("a").alias("root")).unionByName(centres)
