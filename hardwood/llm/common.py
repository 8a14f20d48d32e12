"""Helpers shared by the text operators: row-wise Arrow maps, word hashes, reading tables."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

# Rows that a Python task holds at a time, besides the Arrow batch they come from.
SLICE_ROWS = 256
# Bytes above which such rows, very long texts among them, are taken in smaller pieces.
SLICE_BYTES = 8 << 20
# Words whose hashes (or other results) a Python task remembers before it forgets them all.
CACHE_WORDS = 150_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def folds(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % parts


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name when ``df`` has a column of that name in any case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def sampled(share: float, *columns: str) -> Column:
    """Whether a hash of ``columns`` lies within ``share`` of all hashes; always the same rows.

    However small the share is, it is never rounded to nothing.
    """
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) < F.lit(max(1, int(min(share, 1.0) * (1 << 52))))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Pieces of at most ``rows`` rows and about ``SLICE_BYTES`` bytes (one row at least)."""
    for batch in batches:
        todo = [batch.slice(start, rows) for start in range(0, batch.num_rows, rows)][::-1]
        while todo:
            part = todo.pop()
            if part.num_rows > 1 and part.get_total_buffer_size() > SLICE_BYTES and part.nbytes > SLICE_BYTES:
                middle = part.num_rows // 2
                todo += [part.slice(middle), part.slice(0, middle)]
            else:
                yield part


def _give_back() -> None:
    """Return freed memory to the system: workers are reused, and else keep the most they ever held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Sequence]],
    added: str,
    keep: Sequence[str] | None = None,
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Append the columns ``added`` (DDL), computed slice by slice, to those of ``df``.

    ``make`` runs once per task and returns the function from a slice to one list (or array) per
    added column. ``keep`` names the columns that stay (all by default). A kept column whose name
    equals an added one, in any case, gives way to it.
    """
    fields = _parse_datatype_string(added).fields
    names = {field.name.lower() for field in fields}
    kept = [
        (i, field)
        for i, field in enumerate(df.schema.fields)
        if field.name.lower() not in names and (keep is None or field.name in keep)
    ]
    schema = StructType([field for _, field in kept] + fields)
    added_types = to_arrow_schema(StructType(fields)).types
    out_names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for part in slices(batches, rows):
            new = [
                column if isinstance(column, pa.Array) else pa.array(column, type=kind)
                for column, kind in zip(compute(part), added_types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([part.column(i) for i, _ in kept] + new, out_names)
        _give_back()

    return df.mapInArrow(run, schema)


def fold_rows(
    df: DataFrame,
    fold: Callable[[Iterator[pa.RecordBatch]], Iterator[Sequence]],
    schema: str,
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Rows of ``schema`` that ``fold`` yields, columns at a time, from a partition's slices.

    Slices of whole texts have few rows; narrow rows, such as words, go in slices of more ``rows``.
    """
    types = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fold(slices(batches, rows)):
            arrays = [
                c if isinstance(c, pa.Array) else pa.array(c, type=t)
                for c, t in zip(columns, types.types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, types.names)
        _give_back()

    return df.mapInArrow(run, schema)


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words, in order; empty when there are fewer words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.full(count, size, np.uint64)
    for offset in range(size):
        out = (out ^ hashes[offset : offset + count]) * _MULTIPLIER
        out ^= out >> np.uint64(32)
    return (out * _MIX) ^ (out >> np.uint64(29))


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; with fewer words than ``size``, the whole sequence as one."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(hashes, min(size, len(hashes))))


# Most bits of an id filter: what is broadcast stays below this, however many ids there are.
FILTER_BITS = 1 << 25


def id_filter(ids: DataFrame, expected: int) -> Callable[[str], Column]:
    """A condition on a column that holds for every one of ``ids`` (one column), and few others.

    A one-hash Bloom filter of about sixteen bits an id, ``FILTER_BITS`` at most: beyond that it
    lets more rows pass, which the join that follows drops. It does not hold for NULL.
    """
    bits = 1 << max(10, min(FILTER_BITS.bit_length() - 1, (16 * expected).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long"), F.lit(97)), F.lit(bits))
    words = ids.select(place(ids.columns[0]).alias("spot")).groupBy(F.expr("spot div 32").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(spot % 32 AS INT)))").alias("mask")
    ).toPandas()
    packed = np.zeros(bits >> 5, np.uint32)
    packed[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).astype(np.uint32)
    shared = ids.sparkSession.sparkContext.broadcast(packed)

    @F.pandas_udf("boolean")
    def passes(at: pd.Series) -> pd.Series:
        at = at.to_numpy(np.int64)
        return pd.Series(((shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1).astype(bool))

    return lambda column: F.col(column).isNotNull() & passes(place(column))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, unless their Python finds it on its own.

    Workers import from PYTHONPATH and, with a local master, from the driver's working folder.
    """
    context = spark.sparkContext
    root = Path(__file__).resolve().parents[2]
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if context.master.startswith("local[") or context.master == "local":
        paths.append(Path.cwd().resolve())
    if root in paths or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="hardwood-py-")) / "hardwood.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted((root / "hardwood").rglob("*.py")):
            packed.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
