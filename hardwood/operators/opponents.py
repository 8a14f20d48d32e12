"""The other side of a two-sided event, such as the opponent in a game."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_opponent(
    df: DataFrame,
    event: str,
    side: str,
    opponent: str,
    carry: Mapping[str, str],
    sides: DataFrame | None = None,
    own: Sequence[str] = (),
) -> DataFrame:
    """Add the ``side`` of the other row of the same ``event``, and its ``carry`` columns.

    Rows whose event has no second side get NULLs, as in a left outer self join on equal events
    and unequal sides. An event has at most two rows: reading the opponent of one with more raises
    (:func:`crowded_events` lists them), so no result is silently incomplete. So one aggregated row per event replaces the self join: no
    pairs are formed, and the join back has one row per key on its right side.

    Two rows an event leave nothing to combine before the shuffle: it takes the narrow rows of
    ``sides``, without those of no event, which meet nothing. Events are as many as half the rows,
    and their size is guessed from compressed files, so they are never broadcast.

    ``sides`` may be a narrow frame with the same rows as ``df`` (by event and side) that also
    holds the columns ``own``. Each row gets those of its own side, so that columns computed on
    few columns reach a wide table without a shuffle of their own.
    """
    sides = df if sides is None else sides
    spread = [*carry, *own]
    narrow = sides.select(*dict.fromkeys([event, side, *spread])).filter(F.col(event).isNotNull())
    per_event = narrow.repartition(event).groupBy(event).agg(
        F.min(side).alias("_low"),
        F.max(side).alias("_high"),
        F.count(F.lit(1)).alias("_rows"),
        *[F.min_by(column, side).alias(f"_low_{column}") for column in spread],
        *[F.max_by(column, side).alias(f"_high_{column}") for column in spread],
    )
    joined = df.join(per_event.hint("merge"), event, "left")
    is_low = F.col(side) == F.col("_low")
    is_high = F.col(side) == F.col("_high")
    two_sided = F.col("_low") != F.col("_high")

    crowded = F.raise_error(F.concat(F.lit(f"more than two rows of {event} "), F.col(event).cast("string")))

    def of_other(suffix: str = "") -> Column:
        low, high = F.col(f"_low{suffix}"), F.col(f"_high{suffix}")
        kind = sides.schema[suffix[1:] or side].dataType
        return (
            F.when(F.col("_rows") > 2, crowded.cast(kind))
            .when(two_sided & is_low, high)
            .when(two_sided & is_high, low)
        )

    def of_own(suffix: str) -> Column:
        return F.when(is_low, F.col(f"_low{suffix}")).when(is_high, F.col(f"_high{suffix}"))

    return joined.select(
        *df.columns,
        of_other().alias(opponent),
        *[of_other(f"_{column}").alias(name) for column, name in carry.items()],
        *[of_own(f"_{column}").alias(column) for column in own],
    )


def crowded_events(df: DataFrame, event: str) -> DataFrame:
    """Events with more than two rows: a third side, or a side that is present twice."""
    return (
        df.groupBy(event).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 2)
    )
