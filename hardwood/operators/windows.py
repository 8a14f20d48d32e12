"""Ordered windows over groups of any size.

A plain window puts a whole group into one task. That is right for most groups, but one team,
user or season may hold a large share of all rows. The operators here find such hot groups by
a pre-aggregated count and cut them into ordered chunks: the rows are range-partitioned on the
group and order columns and written with their chunk number, windows run per chunk, and only
the rows at chunk borders (or one total per chunk) meet in one place. The count, and the chunks
when there are hot groups, are computed while the plan is being built.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hardwood.operators.sizes import BROADCAST_ROWS, ONE_TASK_ROWS, hot_groups, same_keys
from hardwood.sinks.scratch import keep

WindowColumn = Callable[[WindowSpec], Column]

_CHUNK, _HASH, _COPY = "_chunk", "_hash", "_copy"
_ADDED = (_CHUNK, _HASH, _COPY)
#: The column that :func:`lay_out` adds.
PART = "_part"


def ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in columns]


def _ordered_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunks: int
) -> tuple[DataFrame, list[Column]]:
    """Cut ``df`` into ``chunks`` ranges of its sort order, written with their chunk number.

    Rows equal in the sort columns are told apart by a hash of the row, and full copies by a
    running number, so no run of equal rows is too large to cut. A task that runs again can
    swap running numbers only between copies, which changes nothing.
    """
    order = [*order, F.col(_HASH).asc(), F.col(_COPY).asc()]
    numbered = df.withColumn(_HASH, F.xxhash64(*df.columns)).withColumn(
        _COPY, F.monotonically_increasing_id()
    )
    ranged = numbered.repartitionByRange(chunks, *ascending(keys), *order)
    written = keep(ranged.withColumn(_CHUNK, F.spark_partition_id()), "ordered_chunks")
    return written, order


def _chunk_count(rows: int, rows_per_task: int) -> int:
    return 1 + 2 * rows // rows_per_task


def look_back(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    depth: int,
    columns: Mapping[str, WindowColumn],
    sized_by: DataFrame | None = None,
    rows_per_task: int = ONE_TASK_ROWS,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add window columns that look at the current row and at most ``depth`` rows before it.

    ``sized_by`` is a stored table with at least as many rows per group as ``df``, for a cheaper
    search for hot groups: those of more than ``rows_per_task`` rows, which are cut into chunks of
    about ``chunk_rows`` (by default as many). End ``order`` with a column that is unique in its
    group to fix the order of ties.
    """
    window_order = ascending(order)
    names = list(columns)

    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return frame.withColumns({name: column(window) for name, column in columns.items()})

    whole = Window.partitionBy(*keys)
    found = hot_groups(df if sized_by is None else sized_by, keys, rows_per_task)
    if found is None:
        return add(df, whole.orderBy(*window_order))

    hot, hot_rows = found
    is_hot = same_keys(df, hot, keys, "_hot_")
    ordinary = add(df.join(hot, is_hot, "left_anti"), whole.orderBy(*window_order))

    chunked, chunk_order = _ordered_chunks(
        df.join(hot, is_hot, "left_semi"),
        keys,
        window_order,
        _chunk_count(hot_rows, chunk_rows or rows_per_task),
    )
    in_chunk = Window.partitionBy(_CHUNK, *keys)
    numbered = (
        add(chunked, in_chunk.orderBy(*chunk_order))
        .withColumn("_from_start", F.row_number().over(in_chunk.orderBy(*chunk_order)))
        .withColumn("_from_end", F.count(F.lit(1)).over(in_chunk) - F.col("_from_start"))
    )
    # Frames of a chunk's first rows reach into earlier chunks. The first and last `depth` rows
    # of all chunks hold every such frame without a gap.
    borders = numbered.filter(
        (F.col("_from_start") <= depth) | (F.col("_from_end") < depth)
    ).drop(*names)
    starts = add(borders, whole.orderBy(*chunk_order)).filter(F.col("_from_start") <= depth)
    rest = numbered.filter(F.col("_from_start") > depth)
    return ordinary.unionByName(
        rest.unionByName(starts).drop("_from_start", "_from_end", *_ADDED)
    )


def lay_out(
    df: DataFrame, keys: Sequence[str], sizes: DataFrame, rows_per_task: int = ONE_TASK_ROWS
) -> DataFrame | None:
    """``df`` in ranges of its groups' sort order, with the number of its range in column ``PART``.

    ``sizes`` holds every group of ``keys`` with its ``rows``. Their prefix sums give each group its
    range, so nothing is sampled and ``df`` is computed once. A window partitioned by ``PART`` and
    the keys needs no further shuffle, and neither does a sort by the keys: sorted within their
    partitions, rows are sorted as a whole. None when there are too many groups to broadcast, or one
    too large for a task.
    """
    groups, largest, total = sizes.agg(F.count(F.lit(1)), F.max("rows"), F.sum("rows")).first()
    if not groups or groups > BROADCAST_ROWS or largest > rows_per_task:
        return None
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // rows_per_task))
    # One row per group: a bounded number, in one task.
    before = Window.orderBy(*ascending(keys)).rowsBetween(Window.unboundedPreceding, -1)
    part = F.coalesce(F.sum("rows").over(before), F.lit(0)) * parts
    placed = sizes.select(
        *[F.col(key).alias(f"_at_{key}") for key in keys], F.floor(part / total).cast("int").alias(PART)
    )
    met = df.join(F.broadcast(placed), same_keys(df, placed, keys, "_at_"))
    return met.select(*df.columns, PART).repartitionById(parts, F.col(PART))


def days_since_previous(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    name: str,
    tie_break: Sequence[str] = (),
    **sizing,
) -> DataFrame:
    """Add the days between ``date`` and that of the group's previous row (NULL for its first)."""
    return look_back(
        df,
        keys,
        [date, *tie_break],
        1,
        {name: lambda window: F.datediff(F.col(date), F.lag(date, 1).over(window))},
        **sizing,
    )


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    rows: int,
    name: str,
    **sizing,
) -> DataFrame:
    """Add the mean of ``value`` over the current row and the ``rows - 1`` rows before it."""
    return look_back(
        df,
        keys,
        order,
        rows - 1,
        {name: lambda window: F.avg(value).over(window.rowsBetween(-(rows - 1), 0))},
        **sizing,
    )


def row_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    rows_per_task: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Number the rows of each group (all rows when ``keys`` is empty) over many tasks."""
    kept = keep(df, "positions")
    chunks = _chunk_count(kept.count(), rows_per_task)
    chunked, chunk_order = _ordered_chunks(kept, keys, order, chunks)
    # Each chunk starts after the rows of all chunks before it: one total per chunk and group.
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        chunked.groupBy(_CHUNK, *keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            *[F.col(column).alias(f"_at_{column}") for column in (_CHUNK, *keys)],
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        )
    )
    in_chunk = Window.partitionBy(_CHUNK, *keys).orderBy(*chunk_order)
    numbered = chunked.withColumn("_in_chunk", F.row_number().over(in_chunk))
    return numbered.join(starts, same_keys(numbered, starts, [_CHUNK, *keys], "_at_")).select(
        *df.columns,
        (F.col("_before") + F.col("_in_chunk")).alias(name),
    )
