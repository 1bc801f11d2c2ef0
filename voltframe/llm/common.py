"""What the operators of this subpackage share: reading, Arrow batches, row keys, shared folders, held-out rows."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workers import discard, settle, shared, ship  # noqa: F401

#: Rows and bytes of text that one step of an Arrow function works on at once; they bound memory, not input.
STEP_ROWS, STEP_BYTES = 4000, 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """True for the rows no model learns from: crc32 of the id's text, modulo 5, is 0 (a null id is never held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def row_key(docs: DataFrame, id_col: str = "doc_id", name: str = "__row") -> DataFrame:
    """Add a long that is unique to each row and rises with ``id_col`` (nulls first).

    Where ids are unique, non-null whole numbers, that is the id itself. Else rows are range-partitioned by id and
    numbered, equal ids in the order of their text's hash, and written to the shared folder, so that numbers stay.
    """
    if docs.schema[id_col].dataType in (T.LongType(), T.IntegerType(), T.ShortType()):
        odd = docs.groupBy(id_col).count().where(F.col(id_col).isNull() | (F.col("count") > 1))
        if odd.isEmpty():
            return docs.withColumn(name, F.col(id_col).cast("long"))
    h = unused(docs, "__h")
    order = [F.col(id_col).asc_nulls_first(), F.col(h)]
    numbered = docs.withColumn(h, F.xxhash64(F.to_json(F.struct("*")))).repartitionByRange(*order).sortWithinPartitions(*order)
    return shared(numbered.drop(h).withColumn(name, F.monotonically_increasing_id()))


def within(sizes: list[tuple], most: int) -> list:
    """Of (key, size) pairs, in their order, each that still fits in ``most`` with those before it; the smallest, if none does."""
    out, total = [], 0
    for key, size in sizes:
        if total + size <= most:
            total += size
            out.append(key)
    return out or [key for key, _ in sorted(sizes, key=lambda x: x[1])[:1]]


def unused(df: DataFrame, name: str) -> str:
    """``name``, or something like it that no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def steps(batches: Iterable[pa.RecordBatch], text: str | None = None, rows: int = STEP_ROWS, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that none has more than ``rows`` rows or, unless of one row, ``size`` bytes in ``text``."""
    for b in batches:
        if not b.num_rows:
            continue
        ends = np.arange(1, b.num_rows + 1) // rows
        if text is not None:
            n = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = ends + np.cumsum(n) // size
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1), b.num_rows]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if j > i:
                yield b.slice(i, j - i)


def texts(b: pa.RecordBatch, col: str) -> list[bytes]:
    """UTF-8 bytes of each row's text; null is empty."""
    return [x or b"" for x in b.column(col).cast(pa.binary()).to_pylist()]


_RESIDENT: dict[Hashable, Any] = {}


def release() -> None:
    """Drop what an earlier task left in this worker, and give its memory back."""
    if _RESIDENT:
        _RESIDENT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def resident(key: Hashable, make: Callable[[], Any]) -> Any:
    """A model that a worker keeps between tasks; it holds one at a time, so that stages don't pile theirs up."""
    if key not in _RESIDENT:
        release()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, *, resides: bool = False) -> DataFrame:
    """``mapInArrow`` in a worker that is rid of other operators' models first; ``resides``: ``fn`` has a resident one itself."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from fn(batches)

    return df.mapInArrow(fn if resides else run, schema)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each length, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
