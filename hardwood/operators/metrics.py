"""Averages, gaps, changes, ranks and tiers.

The aggregate helpers return Column expressions for ``groupBy(...).agg(...)``. ``parts`` and
``mean_of_parts`` split an average into a sum and a count, so that a large table can be reduced
on its own keys before it meets a dimension table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hardwood.operators.sizes import ONE_TASK_ROWS, hot_groups, same_keys
from hardwood.operators.windows import row_positions
from hardwood.sinks.scratch import keep, keep_counted


def won(result: Column) -> Column:
    """1.0 for a win, 0.0 for anything else: an unknown result counts as a loss."""
    return F.when(result == "W", F.lit(1.0)).otherwise(F.lit(0.0))


def win_rate(result: Column) -> Column:
    return F.avg(won(result))


def cond_avg(value: Column, condition: Column) -> Column:
    """Average of ``value`` over the rows that meet ``condition``; NULL when none does."""
    return F.avg(F.when(condition, value))


def gap(value: Column, condition: Column, other: Column) -> Column:
    """Average of ``value`` where ``condition`` holds minus that where ``other`` holds."""
    return cond_avg(value, condition) - cond_avg(value, other)


def parts(name: str, value: Column, condition: Column | None = None) -> list[Column]:
    """The sum and count behind an average, as columns ``{name}_sum`` and ``{name}_n``."""
    chosen = value if condition is None else F.when(condition, value)
    return [F.sum(chosen).alias(f"{name}_sum"), F.count(chosen).alias(f"{name}_n")]


def mean_of_parts(name: str, condition: Column | None = None) -> Column:
    """The average over the rows behind the :func:`parts` columns that meet ``condition`` (or all)."""
    total, rows = (
        F.sum(F.col(part) if condition is None else F.when(condition, F.col(part)))
        for part in (f"{name}_sum", f"{name}_n")
    )
    return F.try_divide(total, rows)


def change_from_previous(value: Column, order: str) -> Column:
    """``value`` minus that of the previous row in ``order``.

    The window has no partition: use it on a report with one row per season.
    """
    window = Window.orderBy(F.col(order).asc_nulls_last())
    return value - F.lag(value, 1).over(window)


def with_ranks(
    df: DataFrame, ranks: Mapping[str, str], rows_per_task: int = ONE_TASK_ROWS
) -> DataFrame:
    """Add a rank, largest value first, per entry ``{rank name: value column}`` of ``ranks``.

    ``df`` is written first, and counted by that. Up to ``rows_per_task`` rows are ranked by one
    sort in one task; beyond that a value's rank follows from the counts of all larger values.
    """
    df, rows = keep_counted(df, "to_rank")
    for name, value in ranks.items():
        if rows <= rows_per_task:
            order = F.col(value).desc_nulls_last()
            df = df.withColumn(name, F.rank().over(Window.orderBy(order)).cast("long"))
            continue
        first = _first_positions(df, value, name, rows, rows_per_task)
        df = df.join(first, same_keys(df, first, [value], "_of_")).drop("_of_" + value)
    return df


def _first_positions(
    df: DataFrame, value: str, name: str, rows: int, rows_per_task: int
) -> DataFrame:
    """The first position of each distinct value among all ``rows``, largest first, as column ``name``.

    Prefix sums of (value, count) in ranges of values; one total per range meets in one task.
    """
    counts = df.groupBy(F.col(value).alias("_of_" + value)).agg(F.count(F.lit(1)).alias("_rows"))
    order = F.col("_of_" + value).desc_nulls_last()
    ranged = counts.repartitionByRange(1 + 2 * rows // rows_per_task, order)
    ranged = keep(ranged.withColumn("_range", F.spark_partition_id()), "value_counts")
    earlier = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(F.col("_range").alias("_at")).agg(F.sum("_rows").alias("_rows"))
    starts = starts.select("_at", F.sum("_rows").over(earlier).alias("_before"))
    larger = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_inside", F.sum("_rows").over(larger))
    position = 1 + F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    return inside.join(starts, F.col("_range") == F.col("_at")).select("_of_" + value, position.alias(name))


def with_tier(
    df: DataFrame,
    tiers: int,
    keys: Sequence[str],
    value: str,
    tie_break: str,
    name: str,
    rows_per_task: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Split each group into ``tiers`` near-equal tiers, largest ``value`` in tier 1.

    ``df`` is written first, and counted by that. Groups of up to ``rows_per_task`` rows are split
    in one task each; when one is larger, all are, by their rows' positions in a range-partitioned
    sort.
    """
    df, rows = keep_counted(df, "to_split")
    order = [F.col(value).desc_nulls_last(), F.col(tie_break).asc_nulls_last()]
    if rows <= rows_per_task or hot_groups(df, keys, rows_per_task) is None:
        return df.withColumn(name, F.ntile(tiers).over(Window.partitionBy(*keys).orderBy(*order)))
    placed = row_positions(df, keys, order, "_position", rows_per_task)
    sizes = placed.groupBy(*[F.col(key).alias("_of_" + key) for key in keys]).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    # The first `_rows % tiers` tiers hold one row more than the others.
    small = F.expr(f"_rows div {tiers}")
    larger = F.col("_rows") % tiers
    in_larger = larger * (small + 1)
    position = F.col("_position") - 1
    tier = F.when(position < in_larger, F.floor(position / (small + 1))).otherwise(
        larger + F.floor(F.try_divide(position - in_larger, small))
    )
    return placed.join(sizes, same_keys(placed, sizes, keys, "_of_")).select(
        *df.columns, (tier + 1).cast("int").alias(name)
    )
