"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Words are lower-cased (A-Z) runs between ASCII white space and punctuation; sets hold shingles of
``size`` words. An item is contained when at least ``percent`` per cent of its distinct shingles
stand anywhere in a document, however long. Jaccard similarity, and with it symmetric MinHash, says
nothing about a short item in a long document, so the items are partitioned by the size of their
sets, and each partition keeps the shingles that are the minima of K hash functions over its
items. Every such minimum is a uniform draw from the item, so it stands in a containing document
with a probability of at least the threshold: K draws all miss with ``(1 - t) ** K`` at most,
below ``MISS``. A partition whose items need more shingles than a document has is not probed.
Candidates are then verified by exact containment of the full sets.

The benchmark is taken in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_SHINGLES`` shingles.
One block at a time is broadcast, for one pass over the documents whose finds are written; the
benchmark's total size is checked, not assumed.

Defined results: an item with fewer words than ``size`` is one shingle, its whole sequence, and is
looked for among the runs of as many words; items without words (or NULL text or id) are contained
nowhere. Documents with NULL or empty text contain nothing. Repeated items, and items that share
an id, are each reported; repeated documents each on their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import (
    WordHashes,
    free_name,
    id_filter,
    map_rows,
    row_count,
    shingle_hashes,
    shingle_set,
)
from hardwood.sinks.scratch import keep

MISS = 1e-6
BLOCK_ITEMS = 20_000
BLOCK_SHINGLES = 4_000_000
_TABLE_BITS = 22
_FOUND = "array<struct<item_id:long,n_shingles:long,n_shared:long>>"

_SPLIT = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_SPLIT).split() if text else []


def draws_for(percent: int) -> int:
    miss = 1 - percent / 100
    return 1 if miss <= 0 else math.ceil(math.log(MISS) / math.log(miss))


class ItemIndex:
    """The sketches of a block of items, by the length of their shingles, and their full sets."""

    def __init__(self, items: list[tuple[int, str]], size: int, percent: int, seed: int = 3):
        hasher = WordHashes()
        self.percent, self.ids, self.sets, self.sizes = percent, [], [], []
        draws: dict[int, list[tuple[int, int, int]]] = {}
        rng = np.random.default_rng(seed)
        mixers = rng.integers(1 << 62, size=draws_for(percent), dtype=np.uint64) * 2 + 1
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            own = shingle_set(hasher.of(words), size)
            at, length = len(self.ids), min(size, len(words))
            self.ids.append(item_id)
            self.sets.append(own)
            self.sizes.append(len(own))
            partition = int(len(own)).bit_length()
            for mixer in mixers:
                minimum = own[np.argmin((own ^ (own >> np.uint64(31))) * mixer)]
                draws.setdefault(length, []).append((int(minimum), partition, at))
        self.lengths = {}
        for length, found in draws.items():
            found = sorted(set(found))
            keys = np.array([f[0] for f in found], np.uint64)
            # A document needs so many shingles to hold any item of the smallest partition here.
            least = min(-(-percent * (1 << (f[1] - 1)) // 100) for f in found)
            marks = np.zeros(1 << _TABLE_BITS, bool)
            marks[(keys >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
            self.lengths[length] = (
                keys, np.array([f[1] for f in found]), np.array([f[2] for f in found]), marks, least
            )

    def found_in(self, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, its shingles, shared shingles) of every item that the words contain."""
        out = []
        for length, (keys, partitions, items, marks, least) in self.lengths.items():
            shingles = shingle_hashes(hashes, length)
            if len(shingles) < least:
                continue
            near = shingles[marks[(shingles >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]]
            if not len(near):
                continue
            hit = np.isin(keys, near)
            if not hit.any():
                continue
            distinct = np.unique(shingles)
            fits = self.percent * (1 << np.maximum(partitions[hit] - 1, 0)) <= 100 * len(distinct)
            for item in np.unique(items[hit][fits]):
                own = self.sets[item]
                at = np.minimum(np.searchsorted(distinct, own), len(distinct) - 1)
                shared = int((distinct[at] == own).sum())
                if 100 * shared >= self.percent * len(own):
                    out.append((self.ids[item], len(own), shared))
        return out


def _item_blocks(items: DataFrame, block_items: int, block_shingles: int) -> tuple[Iterator[list], int]:
    """Lists of (id, text), a bounded number of rows and characters each, and how many there are."""
    rows = keep(items, "benchmark")
    sized = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    # A shingle takes two characters of text at least.
    blocks = max(1, -(-sized.n // block_items), -(-(sized.chars or 0) // (2 * block_shingles))) if sized.n else 0

    def read(block: int) -> list[tuple[int, str]]:
        own = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        return [(r.item, r.text) for r in own.collect()]

    return map(read, range(blocks)), blocks


def contained_items(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", size: int = 5, percent: int = 80, block_items: int = BLOCK_ITEMS,
    block_shingles: int = BLOCK_SHINGLES, name: str = "items",
) -> DataFrame:
    """``docs`` with the column ``name``: an array of the contained items (item_id, n_shingles, n_shared)."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text"))
    items = items.filter("item IS NOT NULL AND text IS NOT NULL")
    blocks, n_blocks = _item_blocks(items, block_items, block_shingles)
    if not n_blocks:
        return docs.withColumn(name, F.array().cast(_FOUND))
    if n_blocks == 1:
        shared = docs.sparkSession.sparkContext.broadcast(ItemIndex(next(blocks), size, percent))
        return map_rows(docs, _finder(shared, docs.columns.index(text)), f"`{name}` {_FOUND}")

    # One pass for each block, whose finds are written before the next block is broadcast, so tasks
    # hold one block at a time. Rows are told apart by a number, as ids may repeat.
    row, hits = free_name(docs, "row"), []
    numbered = keep(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    for items_of_block in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(ItemIndex(items_of_block, size, percent))
        texts = numbered.select(F.col(row).alias("row"), F.col(text).alias("text"))
        found = map_rows(texts, _finder(shared, 1), f"items {_FOUND}", keep=["row"])
        hits.append(keep(found.filter(F.size("items") > 0), "contained"))
        shared.unpersist()
    own = free_name(numbered, "found_row")
    found = reduce(DataFrame.unionByName, hits).groupBy(F.col("row").alias(own)).agg(
        F.array_sort(F.flatten(F.collect_list("items"))).alias(name)
    )
    found = keep(found, "contained")
    # Most rows contain nothing and need not meet the finds.
    touched = id_filter(found.select(own), row_count(found))(row)
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    met = numbered.filter(touched).select(row, *kept).join(found, F.col(row) == F.col(own), "left")
    nothing = F.array().cast(_FOUND)
    out = met.select(*kept, F.coalesce(name, nothing).alias(name))
    return out.unionByName(numbered.filter(~touched).select(*kept, nothing.alias(name)))


def _finder(shared, at: int):
    """Makes the function that finds the items of a broadcast index in the texts of column ``at``."""

    def make():
        hasher, index = WordHashes(), shared.value

        def compute(part):
            return [[
                sorted(
                    [{"item_id": i, "n_shingles": n, "n_shared": s} for i, n, s in index.found_in(hasher.of(words_of(t)))],
                    key=lambda item: tuple(item.values()),
                )
                for t in part.column(at).to_pylist()
            ]]

        return compute

    return make


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    name = free_name(docs, "contained")
    found = contained_items(docs, benchmark, name=name, **options)
    return found.filter(F.size(name) == 0).select(*docs.columns)
