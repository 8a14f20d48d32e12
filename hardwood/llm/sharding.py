"""Shards of near equal bytes, by sampled splitters over a key range.

The key is a hash of the text, so that equal texts are neighbours, then a hash of the id and a row
number. A record's mass is its size plus the mean size, so that ranges are bounded in bytes and in
rows. A sample in which every record's chance is in proportion to its mass gives the quantile
boundaries of many small ranges. Exact bytes and rows per range are then counted: a range that is
overfull, because its sample erred or one text fills it, is subdivided at quantiles of a sample of
its own over the full key, so one text of any weight, also full copies of one row, spreads over as
many ranges as it needs, and a text stays in one range otherwise. Consecutive ranges fill the shards in key order, each boundary where
the running bytes come nearest to an equal share. Slots are numbered within ranges, after the
rows of the ranges before.

Defined results: NULL text counts no bytes (size 1) and has the crc32 of an empty text; NULL ids
and repeated rows are placed like any other, in any order among full copies. An empty table gives
no rows. One record larger than a shard's share leaves its shard larger than the rest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hardwood.sinks.scratch import keep

# Ranges per shard, sampled keys per range, and how full a range may be, in mean ranges.
RANGES_PER_SHARD = 128
KEYS_PER_RANGE = 24
OVERFULL = 1.5
_ROUNDS = 6


def _weighted_sample(rows: DataFrame, expected: int, total: int, salt: int) -> pd.DataFrame:
    """About ``expected`` rows (h, g, weight), each kept with a chance in proportion to its mass."""
    chance = F.least(F.lit(1.0), F.col("mass") * F.lit(expected / max(1, total)))
    draw = (F.pmod(F.xxhash64("g", "h", F.lit(salt)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    picked = rows.withColumn("chance", chance).filter(draw < F.col("chance"))
    return picked.select("h", "g", (F.col("mass") / F.col("chance")).alias("weight")).toPandas()


def _quantiles(sample: pd.DataFrame, keys: list[str], parts: int) -> list[tuple[int, int]]:
    """Up to ``parts - 1`` distinct boundaries of equal weight; a range ends before its boundary."""
    if sample.empty or parts < 2:
        return []
    ordered = sample.sort_values(keys, kind="stable")
    before = ordered["weight"].cumsum().to_numpy() - ordered["weight"].to_numpy()
    at = np.searchsorted(before, before[-1] * np.arange(1, parts) / parts)
    low = -(1 << 63)
    picked = ordered.iloc[np.unique(at)]
    second = picked["g"] if "g" in keys else [low] * len(picked)
    return sorted({(int(h), int(g)) for h, g in zip(picked["h"], second, strict=True)})


def _range_of(boundaries: list[tuple[int, int]]) -> Column:
    """The number of boundaries at or below a record's (h, g)."""
    highs = np.array([b[0] for b in boundaries], np.int64)
    lows = np.array([b[1] for b in boundaries], np.int64)
    pairs = np.empty(len(boundaries), [("h", np.int64), ("g", np.int64)])
    pairs["h"], pairs["g"] = highs, lows

    @F.pandas_udf("int")
    def number(h: pd.Series, g: pd.Series) -> pd.Series:
        h, g = h.to_numpy(np.int64), g.to_numpy(np.int64)
        first, last = np.searchsorted(highs, h, "left"), np.searchsorted(highs, h, "right")
        out = last.copy()
        for i in np.flatnonzero(last > first):  # boundaries with the record's own first key
            out[i] = first[i] + np.searchsorted(lows[first[i] : last[i]], g[i], "right")
        return pd.Series(out.astype(np.int32))

    return number("h", "g")


def _split_overfull(rows: DataFrame, boundaries: list[tuple[int, int]], full: float) -> tuple[list, list, bool]:
    """Exact (bytes, rows) per range, the boundaries with overfull ranges subdivided, and if any were."""
    ranged = rows.withColumn("range", _range_of(boundaries))
    counted = ranged.groupBy("range").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
        F.sum("mass").alias("mass"), F.max("mass").alias("largest"),
    ).toPandas()
    totals = {int(r.range): (int(r.bytes), int(r.rows)) for r in counted.itertuples()}
    heavy = counted[(counted.mass > OVERFULL * full) & (counted.rows > 1) & (counted.mass > counted.largest)]
    added: set[tuple[int, int]] = set()
    if len(heavy):
        wanted = ranged.filter(F.col("range").isin([int(r) for r in heavy.range]))
        weight = int(heavy.mass.sum())
        parts = {int(r.range): int(np.ceil(r.mass / full)) for r in heavy.itertuples()}
        sample = _weighted_sample(wanted, KEYS_PER_RANGE * sum(parts.values()), weight, len(boundaries))
        found = _range_numbers(sample, boundaries)
        for number, own in sample.groupby(found):
            added.update(_quantiles(own, ["h", "g"], parts.get(int(number), 1)))
    wider = sorted(set(boundaries) | added)
    return [totals.get(i, (0, 0)) for i in range(len(boundaries) + 1)], wider, len(wider) > len(boundaries)


def _range_numbers(sample: pd.DataFrame, boundaries: list[tuple[int, int]]) -> np.ndarray:
    import bisect

    pairs = zip(sample["h"].astype("int64"), sample["g"].astype("int64"), strict=True)
    return np.array([bisect.bisect_right(boundaries, (int(h), int(g))) for h, g in pairs], int)


def shard_by_bytes(
    docs: DataFrame, shards: int = 8, *, doc_id: str = "doc_id", text: str = "text",
    ranges_per_shard: int = RANGES_PER_SHARD,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    content = F.coalesce(F.col(text), F.lit(""))
    # The two keys are uniform, whatever the texts and ids are.
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.xxhash64(content).alias("h"),
    )
    # Full copies are told apart by a number, which is the same in all later reads as it is written.
    number = F.monotonically_increasing_id()
    rows = rows.withColumn("g", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "size", F.lit(5), number))
    rows = keep(rows, "shard_keys")
    n, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    total = total or 0
    # Half of a row's mass is its share of the bytes, half its share of the rows.
    mean = -(-total // max(1, n))
    rows = rows.withColumn("mass", F.col("size") + F.lit(mean))
    ranges = shards * ranges_per_shard
    full = max(1.0, (total + n * mean) / ranges)
    boundaries = _quantiles(_weighted_sample(rows, ranges * KEYS_PER_RANGE, total + n * mean, 0), ["h"], ranges)
    for _ in range(_ROUNDS):
        totals, wider, again = _split_overfull(rows, boundaries, full)
        if not again:
            break
        boundaries = wider
    else:
        totals = _split_overfull(rows, boundaries, full)[0]

    # A range goes where the middle of its bytes falls among the equal shares.
    sizes = np.array([t[0] for t in totals], float)
    middle = np.cumsum(sizes) - sizes / 2
    shard_of = np.minimum((middle * shards / max(1, total)).astype(int), shards - 1)
    before: list[int] = []
    filled = [0] * shards
    for (_, count), shard in zip(totals, shard_of, strict=True):
        before.append(filled[shard])
        filled[shard] += count
    spark = docs.sparkSession
    placed = spark.createDataFrame(
        [(i, int(s), int(b)) for i, (s, b) in enumerate(zip(shard_of, before, strict=True))],
        "range int, shard int, rows_before long",
    )
    window = Window.partitionBy("range").orderBy("h", "g", "doc_id")
    numbered = rows.withColumn("range", _range_of(boundaries)).withColumn("in_range", F.row_number().over(window))
    # At most a fixed number of ranges per shard plus the subdivided ones: a bounded table.
    return numbered.join(F.broadcast(placed), "range").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rows_before") + F.col("in_range") - 1).alias("slot")
    )
