"""What the operators share: shared folders, written tables, Arrow helpers and components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vitrine.operators.graph import components  # noqa: F401
from vitrine.sources.shared import shared_dir, write_table  # noqa: F401


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Send at most ``rows`` documents to a Python worker at once, which bounds its memory; a smaller
    number that the session has set already stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after whose last batch the worker gives unused memory back: it lives on, idle or in
    other stages, beside the executor's JVM."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped


def text_bytes(column: str = "text") -> F.Column:
    """The UTF-8 bytes of a text column, empty for null."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def binary_views(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow binary column (no nulls) and its n + 1 offsets, without copying."""
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes together (a longer row stands alone)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (murmur3), for uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
