"""Whole numbers packed into bytes while a wide row is shuffled.

A row in a shuffle spends eight bytes on every integer, however small, and compression leaves about
three of them. An array of bytes spends one. Rows with a number that no byte holds keep all theirs as
integers, so every value comes back as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a byte holds here: counts up to the points of a game, and margins below zero.
LOWEST, HIGHEST = -100, 155

_BYTES, _INTS = "_packed_bytes", "_packed_ints"


def pack(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with its int ``columns`` in arrays; :func:`unpacked` gives them back."""
    whole = df.select(*[name for name in df.columns if name not in columns], F.array(*columns).alias(_INTS))
    # Both are NULL if all values are, which fit too.
    low, high = F.array_min(_INTS), F.array_max(_INTS)
    fits = F.coalesce((low >= LOWEST) & (high <= HIGHEST), F.lit(True))
    # The lowest eight bits, as a signed number: no arithmetic that could overflow.
    bits = F.array(*[F.shiftright(F.shiftleft(F.col(_INTS)[at], 24), 24) for at in range(len(columns))])
    return whole.withColumns(
        {_BYTES: F.when(fits, bits.cast("array<tinyint>")), _INTS: F.when(~fits, F.col(_INTS))}
    )


def unpacked(columns: Sequence[str]) -> dict[str, Column]:
    """The int columns that :func:`pack` replaced, by name."""

    def column(at: int) -> Column:
        bits = F.col(_BYTES)[at].cast("int")
        return F.coalesce(F.when(bits < LOWEST, bits + 256).otherwise(bits), F.col(_INTS)[at])

    return {name: column(at) for at, name in enumerate(columns)}
