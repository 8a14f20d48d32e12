"""Size checks that decide between a broadcast or single-task plan and a distributed one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.sinks.scratch import keep

# Most rows of narrow tables that one task sorts, or that one executor holds as a broadcast.
ONE_TASK_ROWS = 1_000_000
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when a count proves ``df`` small; otherwise leave the join to Spark.

    For narrow tables that are cheap to count, such as written dimension tables.
    """
    return F.broadcast(df) if df.count() <= rows else df


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Equality of key columns in which NULL equals NULL, as in grouping."""
    return reduce(
        lambda a, b: a & b, [left[key].eqNullSafe(right[prefix + key]) for key in keys]
    )


def hot_groups(
    df: DataFrame, keys: Sequence[str], rows: int = ONE_TASK_ROWS
) -> tuple[DataFrame, int] | None:
    """The groups of ``keys`` with more than ``rows`` rows, and how many rows they hold.

    No group is larger than the whole table, which for a stored table is counted from its file
    footers. Beyond that, counts are combined before the shuffle, so a hot key costs no more
    than another. At most one group per ``rows`` rows can be hot, which bounds the returned
    table. Its columns carry the prefix ``_hot_``.
    """
    if df.count() <= rows:
        return None
    hot = (
        df.groupBy(*[F.col(key).alias(f"_hot_{key}") for key in keys])
        .agg(F.count(F.lit(1)).alias("_hot_rows"))
        .filter(F.col("_hot_rows") > rows)
    )
    found = hot.agg(F.sum("_hot_rows")).first()[0]
    if found is None:
        return None
    return keep(hot.drop("_hot_rows"), "hot_groups"), found
