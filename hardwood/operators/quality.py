"""Checks for declared keys and required values. Each returns the violations as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are NULL or occur on more than one row, with their number of rows."""
    any_null = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter((F.col("rows") > 1) | any_null)
    )


def foreign_key_violations(
    df: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Values of ``column`` that ``parent`` lacks, with their number of rows. NULL is allowed.

    Values are counted before the join, so a hot value reaches it as one row.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_key).alias("_known"))
    return counts.join(known, counts[column] == known["_known"], "left_anti")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Required columns that hold NULLs, with the number of rows that do; one pass over all."""
    nulls = df.agg(*[F.count_if(F.col(column).isNull()).alias(column) for column in columns])
    return nulls.unpivot([], list(columns), "column_name", "null_rows").filter(
        F.col("null_rows") > 0
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.col("rows")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def order_violations(spark: SparkSession, uri: str, order: Sequence[str]) -> DataFrame:
    """Rows of the written table at ``uri`` that stand before a row they belong after, NULLs last.

    ``order`` holds SQL expressions. A Parquet folder has no row order of its own; what was written
    in order lies in files whose names follow each other. So each file's rows are compared with the
    row before them, and each file's first row with the last row of the file before: one row per
    file meets there. Returns file_name and row_index.
    """
    keys = [part for text in order for part in (F.expr(text).isNull(), F.expr(text))]
    named = [key.alias(f"k{i}") for i, key in enumerate(keys)]
    rows = spark.read.parquet(uri).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.row_index").alias("row_index"),
        F.struct(*named).alias("key"),
    )
    in_file = Window.partitionBy("file_name").orderBy("row_index")
    inside = rows.withColumn("before", F.lag("key").over(in_file))
    ends = rows.groupBy("file_name").agg(
        F.min("row_index").alias("row_index"),
        F.min_by("key", "row_index").alias("key"),
        F.max_by("key", "row_index").alias("last"),
    )
    between = ends.withColumn("before", F.lag("last").over(Window.orderBy("file_name"))).drop("last")
    checked = inside.unionByName(between.select(*inside.columns))
    return checked.filter(F.col("before") > F.col("key")).select("file_name", "row_index")
