"""Column expressions that keep the target engine's results where Spark's defaults differ.

The results to match come from an engine that rounds in binary, narrows doubles half to even,
names weekdays in full and sorts NULLs last. Everything here is a built-in Column expression,
so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, digits: int) -> Column:
    """Round a double after scaling it in binary, halves away from zero.

    Spark's own ``round(x, n)`` rounds the printed decimal, so 1.005 becomes 1.01 there and 1.0
    here. The sign is put back last, which keeps the negative zero of small negative values.
    """
    scale = float(10**digits)
    return F.signum(x) * F.round(F.abs(x) * F.lit(scale)) / F.lit(scale)


def to_int_half_even(x: Column) -> Column:
    """Narrow a floating-point column to a 32-bit integer, halves to the even neighbour."""
    return F.rint(x).cast("int")


def weekday_name(date: Column) -> Column:
    """Full English weekday name (``Thursday``)."""
    return F.date_format(date, "EEEE")


def concat_skip_nulls(*parts: Column) -> Column:
    """Concatenate strings, leaving NULL parts out instead of returning NULL."""
    return F.concat_ws("", *parts)
