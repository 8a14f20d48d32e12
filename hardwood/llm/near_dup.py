"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Words are runs of other than ASCII white space, A-Z lower-cased; a document's set holds its
distinct shingles of ``size`` words, or the whole sequence when it has fewer. Two documents are
linked when 100 * shared >= percent * union, and the components of links are found exactly among
the candidates.

1. *Signatures.* Circulant MinHash needs two permutations: sigma puts a shingle into one of 2^20
   places, pi orders the places, and coordinate k uses pi shifted circularly by k. All K values of
   a shingle thus lie side by side in pi. K follows from the threshold: enough bands of four rows
   for a link to be missed with a probability below ``MISS``.
2. *Exact copies* (equal sets, by a 128-bit fingerprint) collapse to their smallest id first.
3. *Families.* Within a band's bucket, signatures alone decide: the members similar to a pivot
   join its family, and only those not certainly close stay for the next pivot. Buckets larger
   than ``BUCKET_ROWS`` are peeled by one pivot at a time over many tasks, then cut into pairs of
   blocks, so no bucket meets in one task and no pairs are emitted, only one edge per member.
4. *Verification.* Each family's full sets meet, cut into pairs of blocks bounded in rows and
   shingles. A walk over posting lists finds every link of the block, but yields one edge per
   member: to the smallest id of its component there.

Defined results: a document without words (also NULL text) has an empty set, links with nothing
and is its own component. Rows with a NULL id are not linked, have a NULL component and are kept.
Rows that share an id and a text are one document; rows that share an id but not a text are
compared each, and links of either count for the id. Very long texts are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import WordHashes, free_name, id_filter, map_rows, row_count, shingle_set
from hardwood.llm.components import join_counted, smallest_reachable
from hardwood.sinks.scratch import keep

ROWS_PER_BAND = 4
MISS = 1e-5
_PLACES_BITS = 20
# Most members of a bucket (signatures), and of a family's block (sets), in one task, and most
# shingles of such a block. They only say where work is cut; results do not depend on them.
BUCKET_ROWS = 4096
BLOCK_ROWS = 2048
BLOCK_SHINGLES = 4_000_000
_PEELS = 4


def bands_for(percent: int) -> int:
    hit = (percent / 100) ** ROWS_PER_BAND
    return math.ceil(math.log(MISS) / math.log(1 - hit))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


class Circulant:
    """Signatures of K coordinates from two permutations, the second shifted circularly."""

    def __init__(self, coordinates: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        places = 1 << _PLACES_BITS
        pi = rng.permutation(places).astype(np.int32)
        self.ring = np.lib.stride_tricks.sliding_window_view(
            np.concatenate([pi, pi[:coordinates]]), coordinates
        )
        # sigma: an odd multiplier and an offset permute the 64-bit hashes; their top bits are places.
        self.multiplier, self.offset = rng.integers(1 << 62, size=2, dtype=np.uint64) * 2 + 1

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        places = ((hashes * self.multiplier + self.offset) >> np.uint64(64 - _PLACES_BITS)).astype(np.int64)
        best = self.ring[places[:4096]].min(axis=0)
        for start in range(4096, len(places), 4096):
            np.minimum(best, self.ring[places[start : start + 4096]].min(axis=0), out=best)
        return best


def _signed(docs: DataFrame, doc_id: str, text: str, size: int, coordinates: int) -> DataFrame:
    """doc_id, n_shingles, fp (NULL for an empty set) and signature of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def make():
        hasher, ring = WordHashes(), Circulant(coordinates)

        def compute(part):
            sizes, prints, signatures = [], [], []
            for value in part.column(1).to_pylist():
                shingles = shingle_set(hasher.of(words_of(value)), size)
                sizes.append(len(shingles))
                prints.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(ring.signature(shingles).tobytes() if len(shingles) else None)
            return sizes, prints, signatures

        return compute

    return map_rows(rows, make, "n_shingles long, fp binary, signature binary", keep=["doc_id"])


def _attach(part: np.ndarray, near: float, sure: float) -> np.ndarray:
    """The row each row's family starts at, from signatures (rows by coordinates)."""
    family = np.arange(len(part))

    def root(i: int) -> int:
        while family[i] != i:
            family[i] = family[family[i]]
            i = family[i]
        return i

    left = np.arange(len(part))
    while len(left) > 1:
        alike = (part[left] == part[left[0]]).mean(axis=1)
        pivot = root(left[0])
        for i in left[1:][alike[1:] >= near]:
            other = root(i)
            if other != pivot:
                low, high = sorted((other, pivot))
                family[high] = pivot = low
        left = left[1:][alike[1:] < sure]
    return np.array([root(i) for i in range(len(part))])


def _blocks(df: DataFrame, key: str, member: str) -> DataFrame:
    """Deal rows with ``n_blocks`` of their ``key`` to the pairs of blocks they take part in."""
    own = F.pmod(F.xxhash64(member, F.lit(11)), F.col("n_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    dealt = df.withColumn("own", own).withColumn("other", other)
    return dealt.withColumn(
        "tile", F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other"))
    ).drop("own", "other")


def _by_tile(df: DataFrame, yields, columns: str) -> DataFrame:
    """Edges that ``yields(table)`` makes of each tile, sorted into it."""
    import pyarrow as pa

    def run(group: pa.Table) -> pa.Table:
        a, b = yields(group)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return df.groupBy("tile").applyInArrow(run, columns)


def _bucket_edges(
    reps: DataFrame, bands: int, near: float, sure: float, bucket_rows: int
) -> DataFrame:
    """Edges (a, b) that tie every two documents that may be linked into one family."""
    keys = F.array(*[
        F.xxhash64(F.lit(band), F.substring("signature", 1 + 4 * ROWS_PER_BAND * band, 4 * ROWS_PER_BAND))
        for band in range(bands)
    ])
    members = keep(reps.select(F.col("doc_id").alias("rep"), F.explode(keys).alias("bucket")), "buckets")
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = join_counted(members, crowded, "bucket", "members", row_count(members))
    signed = reps.select(F.col("doc_id").alias("rep"), "signature")
    crowd = keep(shared.join(signed, "rep"), "crowded")

    coordinates = bands * ROWS_PER_BAND

    def edges(group):
        ids = group.column("rep").to_numpy()
        order = np.argsort(ids, kind="stable")
        packed = b"".join(group.column("signature").to_pylist())
        part = np.frombuffer(packed, np.int32).reshape(len(ids), coordinates)[order]
        ids, first = ids[order], _attach(part, near, sure)
        moved = np.flatnonzero(first != np.arange(len(ids)))
        return ids[first[moved]], ids[moved]

    small = crowd.filter(F.col("members") <= bucket_rows).withColumn("tile", F.col("bucket"))
    found = _by_tile(small.drop("members", "bucket"), edges, "a long, b long")
    hot = crowd.filter(F.col("members") > bucket_rows).drop("members")
    for _ in range(_PEELS):
        if hot.isEmpty():
            return found
        # One pivot against all other members of its bucket; the sure ones need no more pivots.
        pivot = hot.groupBy("bucket").agg(
            F.min(F.struct("rep", "signature")).alias("p"), F.count(F.lit(1)).alias("members")
        )
        pivot = pivot.select("bucket", F.col("p.rep").alias("a"), F.col("p.signature").alias("to"), "members")
        met = join_counted(hot, pivot, "bucket", "members", row_count(hot)).drop("members")
        alike = keep(map_rows(met, lambda: lambda part: [_alike(part, "signature", "to")], "alike double"), "peeled")
        found = found.unionByName(alike.filter((F.col("alike") >= near) & (F.col("rep") != F.col("a")))
                                  .select("a", F.col("rep").alias("b")))
        hot = keep(alike.filter(F.col("alike") < sure).select("rep", "bucket", "signature"), "hot")
    counted = hot.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    counted = counted.withColumn("n_blocks", F.ceil(2 * F.col("members") / bucket_rows))
    met = join_counted(hot, counted, "bucket", "members", row_count(hot)).drop("members")
    dealt = _blocks(met, "bucket", "rep").dropDuplicates(["tile", "rep"])
    return found.unionByName(_by_tile(dealt.drop("n_blocks", "bucket"), edges, "a long, b long"))


def _alike(part, left: str, right: str) -> list[float]:
    names = part.schema.names
    pairs = zip(part.column(names.index(left)).to_pylist(), part.column(names.index(right)).to_pylist(), strict=True)
    return [float((np.frombuffer(a, np.int32) == np.frombuffer(b, np.int32)).mean()) for a, b in pairs]


def linked_components(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The smallest id of each set's component of links, by a walk over posting lists."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owners = np.repeat(np.arange(n), sizes)
    values = np.concatenate(sets) if n else np.empty(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, int)
    ends, distinct = np.append(starts[1:], len(values)), values[starts] if len(values) else values
    smallest, todo = np.full(n, -1), set(range(n))
    for seed in np.argsort(ids, kind="stable"):
        if smallest[seed] >= 0:
            continue
        smallest[seed], queue = seed, [seed]
        todo.discard(seed)
        while queue and todo:
            x = queue.pop()
            at = np.searchsorted(distinct, sets[x])
            low, count = starts[at], ends[at] - starts[at]
            several = count > 1
            low, count = low[several], count[several]
            if not len(low):
                continue
            flat = np.repeat(low - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
            shared = np.bincount(owners[flat], minlength=n)
            linked = 100 * shared >= percent * (sizes + sizes[x] - shared)
            for y in np.flatnonzero(linked & (smallest < 0)):
                smallest[y] = seed
                todo.discard(y)
                queue.append(y)
    return ids[smallest]


def _verified(
    docs: DataFrame, reps: DataFrame, families: DataFrame, doc_id: str, text: str, size: int,
    percent: int, block_rows: int, block_shingles: int,
) -> DataFrame:
    """Edges (a, b) between documents of one component of true links."""
    sized = families.join(reps.select(F.col("doc_id").alias("id"), "n_shingles"), "id")
    sized = keep(sized, "families")
    blocks = sized.groupBy("root").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("shingles")
    )
    cut = F.ceil(F.greatest(F.col("members") / block_rows, F.col("shingles") / block_shingles))
    # A family that fits one block is one tile; of another, every pair of blocks is one.
    blocks = blocks.select("root", "members", F.when(cut > 1, 2 * cut).otherwise(1).alias("n_blocks"))
    met = join_counted(sized.drop("n_shingles"), blocks, "root", "members", row_count(sized))
    dealt = _blocks(met, "root", "id").dropDuplicates(["tile", "id"]).select("tile", "id")
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    # Most documents are in no family: their texts need not be shuffled.
    texts = texts.filter(id_filter(sized.select("id"), row_count(sized))("id"))
    tiles = dealt.join(texts, "id")

    def edges(group):
        hasher = WordHashes()
        ids = group.column("id").to_numpy()
        sets = [shingle_set(hasher.of(words_of(t)), size) for t in group.column("text").to_pylist()]
        roots = linked_components(ids, sets, percent)
        moved = roots != ids
        return roots[moved], ids[moved]

    return _by_tile(tiles, edges, "a long, b long")


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 5,
    percent: int = 80, bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    bands = bands_for(percent)
    far = 1 - percent / 100
    noise = 5 * math.sqrt(far * (1 - far) / (bands * ROWS_PER_BAND))
    # Distances between signatures obey the triangle inequality: what lies within `1 - sure` of a
    # pivot has all its links (within far + noise) inside `1 - near` of it.
    sure = 0.8
    near = sure - far - noise
    signed = keep(_signed(docs, doc_id, text, size, bands * ROWS_PER_BAND), "signatures")
    real = signed.filter("doc_id IS NOT NULL AND fp IS NOT NULL")
    copies = keep(real.groupBy("fp").agg(F.min("doc_id").alias("rep")), "copies")
    chosen = copies.select("fp", F.col("rep").alias("doc_id"))
    reps = keep(real.join(chosen, ["fp", "doc_id"], "left_semi").dropDuplicates(["fp"]).drop("fp"), "reps")

    edges = keep(_bucket_edges(reps, bands, near, sure, bucket_rows), "family_edges")
    families = smallest_reachable(edges)
    links = keep(_verified(docs, reps, families, doc_id, text, size, percent, block_rows, block_shingles), "links")
    # An id with several texts ties their copies together.
    several = real.select("doc_id", "fp").distinct().join(copies, "fp").filter("doc_id <> rep")
    several = several.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    roots = smallest_reachable(links.unionByName(_tied(several, real)))
    member = real.select("doc_id", "fp").distinct().join(copies, "fp").select("doc_id", "rep")
    member = member.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    member = member.groupBy("doc_id").agg(F.min(F.coalesce("root", "rep")).alias("component"))
    out = signed.select("doc_id", "n_shingles").join(member, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _tied(edges: DataFrame, real: DataFrame) -> DataFrame:
    """Of ``edges``, those of ids that stand for more than one text."""
    many = real.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y"))
    many = many.filter("x <> y").select(F.col("doc_id").alias("b"))
    return edges.join(many, "b", "left_semi").select("a", "b")


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, one row of each document."""
    found = keep(near_duplicates(docs, doc_id=doc_id, text=text, **options), "near_duplicates")
    own, kept = free_name(docs, "id"), free_name(docs, "kept")
    ids = found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(own))
    ids = ids.agg(F.max("kept").alias(kept), F.count(F.lit(1)).alias("copies"))
    judged = keep(ids.filter(~F.col(kept) | (F.col("copies") > 1)).select(own, kept), "judged")
    # Only rows whose id may be dropped or repeated have to meet the decisions; the rest pass.
    touched = id_filter(judged.select(own), row_count(judged))(doc_id)
    met = docs.filter(touched).join(judged, F.col(doc_id).cast("long") == F.col(own), "left")
    out = docs.filter(~touched).unionByName(met.filter(F.col(own).isNull()).select(*docs.columns))
    if judged.filter(kept).isEmpty():
        return out
    # Of rows that share an id, one stays.
    return out.unionByName(met.filter(kept).select(*docs.columns).dropDuplicates([doc_id]))
