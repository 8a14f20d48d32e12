"""Near-duplicate documents by 64-bit SimHash and deletion-variant signatures.

Words are runs of other than ASCII white space, A-Z lower-cased. Every shingle of ``size`` words
(repeats included, joined by one space; the whole sequence when there are fewer words) has a 64-bit
hash, and a fingerprint bit is 1 when it is set in over half of them. Documents are linked when their
fingerprints differ in at most three bits.

1. *Fewer segments.* Exact segment indexes need one segment more than bits may differ. Here the 64
   bits are cut into two halves only: of three differing bits, one half holds at most one.
2. *Deletion variants.* Each distinct half is indexed as it is and with each of its bits deleted. Two
   halves with at most one differing bit share an entry, so an equality join finds them. An entry
   with a deleted bit counts only when both values of that bit occur. The index holds distinct halves
   and their numbers, not fingerprints, so an entry never has more than two rows.
3. *Crowded entries.* Fingerprints that share an entry with more than ``BUCKET_ROWS`` others are
   indexed again, within it, by the two quarters of the other half. What then shares an entry differs
   in at most 18 bit places, so no group exceeds 2^18 fingerprints whatever the input; those still
   crowded are cut into pairs of blocks.
4. *Verification.* Each task walks through its groups' fingerprints, comparing those not yet reached,
   and yields one edge per fingerprint: to the smallest of its component there, so no group's pairs
   are emitted. Copies (equal fingerprints) collapse before to their smallest id.

Defined results: a document without words (also NULL text) has fingerprint zero and is linked like
any other. Rows with a NULL id have a fingerprint, but link nothing and have a NULL component. Rows
that repeat an id are compared each, and links of any count for the id. Texts are read whole, also
very long ones. An empty table gives no rows. Of the input only id and text are read, so extra
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import map_rows, row_count
from hardwood.llm.components import join_counted, smallest_reachable
from hardwood.llm.near_dup import words_of
from hardwood.sinks.scratch import keep

SEED = 42
MOST_BITS = 3
#: Most fingerprints compared in one group. It says where work is cut; results do not depend on it.
BUCKET_ROWS = 4096
_HASHES = 1 << 16


def fingerprint(text: str | None, size: int = 3) -> int:
    words = words_of(text)
    if not words:
        return 0
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(words) - size + 1].tolist()
    ends, total = ends[size - 1 :].tolist(), np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for low in range(0, len(starts), _HASHES):
        spans = zip(starts[low : low + _HASHES], ends[low : low + _HASHES], strict=True)
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        # Sums of up to 255 rows fit into bytes.
        whole = len(bits) // 255 * 255
        total += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed number) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def make():
        return lambda part: [[fingerprint(value, size) for value in part.column(1).to_pylist()]]

    return map_rows(rows, make, "fp long", keep=["doc_id"])


def _bits(value: Column, shift: Column | int, width: int) -> Column:
    moved = F.call_function("shiftrightunsigned", value, F.lit(shift) if isinstance(shift, int) else shift)
    return moved.bitwiseAND(F.lit((1 << width) - 1))


def _grouped(rows: DataFrame, parts: list[Column], width: int, used: int) -> DataFrame:
    """Rows (rep, fp) dealt to groups that hold every two with a part of at most one differing bit.

    ``parts`` are numbers of ``used`` bits, the lowest ``width`` of them the bits that may differ.
    Adds ``entry`` (the group) and ``members``, for each group of two or more.
    """
    halves = keep(rows.select("rep", "fp", F.explode(F.array(*parts)).alias("part")), "halves")
    counted = keep(halves.groupBy("part").agg(F.count(F.lit(1)).alias("own")), "parts")
    places = F.explode(F.expr(f"sequence(0, {width - 1})"))
    cleared = F.expr("part & ~shiftleft(1L, place)")
    # The parts are few bytes, and many rows of variants: they are spread before they become those.
    spread = counted.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part")
    variants = spread.select("part", "own", places.alias("place")).select(
        (cleared + F.expr(f"shiftleft(place + 1L, {used})")).alias("entry"), "own", "place"
    )
    # Both values of the deleted bit occur when two distinct parts have the entry.
    both = variants.groupBy("entry", "place").agg(F.count(F.lit(1)).alias("sides"), F.sum("own").alias("members"))
    both = both.filter("sides = 2").withColumn("zero", F.col("entry").bitwiseAND(F.lit((1 << used) - 1)))
    both = keep(both, "variants")
    one = F.expr("zero | shiftleft(1L, place)")
    wild = both.select("entry", "members", F.explode(F.array("zero", one)).alias("part"))
    same = counted.filter("own > 1").select(F.col("part").alias("entry"), F.col("own").alias("members"), "part")
    # At most one entry per bit and one more: a list of bounded length for each part.
    entries = wild.unionByName(same).groupBy("part").agg(F.collect_list(F.struct("entry", "members")).alias("entries"))
    entries = entries.join(counted, "part")
    met = join_counted(halves, entries, "part", "own", row_count(halves))
    return met.select("rep", "fp", F.explode("entries").alias("at")).select("rep", "fp", "at.entry", "at.members")


def _linked(reps: np.ndarray, prints: np.ndarray) -> tuple[list, list]:
    """An edge from the smallest id of each component of a group to each of its other members."""
    order = np.argsort(reps, kind="stable")
    reps, prints = reps[order], prints[order]
    a, b = [], []
    left = np.arange(len(reps))
    while len(left) > 1:
        seed, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            near = np.bitwise_count(prints[left] ^ prints[queue.pop()]) <= MOST_BITS
            if near.any():
                reached, left = left[near], left[~near]
                a.extend([reps[seed]] * len(reached))
                b.extend(reps[reached].tolist())
                queue.extend(reached.tolist())
    return a, b


def _edges(dealt: DataFrame) -> DataFrame:
    """Edges (a, b) of every group of (entry, rep, fp); groups are bounded, and come one after another."""
    sorted_rows = dealt.select("entry", "rep", "fp").repartition("entry").sortWithinPartitions("entry")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), np.int64)

        def solve(rows: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
            sizes = np.diff(np.append(starts, len(rows)))
            prints = rows[:, 2].astype(np.uint64)
            first = starts[sizes == 2]
            near = np.bitwise_count(prints[first] ^ prints[first + 1]) <= MOST_BITS
            a, b = rows[first[near], 1].tolist(), rows[first[near] + 1, 1].tolist()
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                more = _linked(rows[start : start + size, 1], prints[start : start + size])
                a.extend(more[0])
                b.extend(more[1])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([column.to_numpy() for column in batch.columns])
            held = np.vstack([held, rows])
            # The last group may go on in the next batch.
            whole = np.searchsorted(held[:, 0], held[-1, 0])
            if whole:
                yield solve(held[:whole])
                held = held[whole:]
        if len(held):
            yield solve(held)

    return sorted_rows.mapInArrow(run, "a long, b long")


def _links(prints: DataFrame, bucket_rows: int) -> DataFrame:
    """Edges between ids of distinct fingerprints (rep, fp) that give the components of all links."""
    value = F.col("fp")
    halves = [_bits(value, 0, 32), _bits(value, 32, 32) + F.lit(1 << 32)]
    dealt = keep(_grouped(prints, halves, width=32, used=33), "groups")
    links = keep(_edges(dealt.filter(F.col("members") <= bucket_rows)), "links")
    crowded = dealt.filter(F.col("members") > bucket_rows)
    if crowded.isEmpty():
        return links
    # An entry says which half its members share; the quarters of the other half part them further.
    quarter = F.when(_bits(F.col("entry"), 32, 1) == 0, 32).otherwise(0)
    within = F.col("entry") * (1 << 17)
    quarters = [within + _bits(value, quarter, 16), within + _bits(value, quarter + 16, 16) + F.lit(1 << 16)]
    again = keep(_grouped(crowded.select("rep", "fp", "entry"), quarters, width=16, used=56), "groups")
    fine = again.filter(F.col("members") <= bucket_rows)
    blocks = F.ceil(2 * F.col("members") / bucket_rows)
    own = F.pmod(F.xxhash64("rep"), blocks)
    cut = again.filter(F.col("members") > bucket_rows).withColumn("own", own)
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    tile = F.xxhash64("entry", F.least("own", "other"), F.greatest("own", "other"))
    tiles = cut.select(tile.alias("entry"), "rep", "fp")
    return links.unionByName(keep(_edges(fine), "links")).unionByName(keep(_edges(tiles), "links"))


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 3,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (the smallest id reachable)."""
    signed = keep(fingerprints(docs, doc_id, text, size), "fingerprints")
    real = signed.filter("doc_id IS NOT NULL")
    prints = keep(real.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "prints")
    links = _links(prints.select("rep", "fp"), bucket_rows)
    # An id with several texts ties their fingerprints together.
    several = real.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).filter("x <> y")
    several = real.join(several.select("doc_id"), "doc_id", "left_semi").distinct()
    tied = several.join(prints, "fp").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    roots = smallest_reachable(links.unionByName(tied)).select(F.col("id").alias("rep"), "root")
    reached = prints.join(roots, "rep", "left").select("fp", F.coalesce("root", "rep").alias("component_id"), "copies")
    reached = keep(reached, "components")
    found = join_counted(signed.filter("doc_id IS NOT NULL"), reached, "fp", "copies", row_count(real))
    nameless = signed.filter("doc_id IS NULL").withColumn("component_id", F.lit(None).cast("long"))
    return found.select("doc_id", "fp", "component_id").unionByName(nameless)
