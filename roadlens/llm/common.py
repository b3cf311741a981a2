"""Helpers shared by the corpus operators: settling intermediate tables, sized broadcasts, Arrow text."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.session import checkpoint_root

BROADCAST_ROWS = 100_000  # a thin table (a few dozen bytes a row) up to this many rows is broadcast


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there: its lineage is cut."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint()


def sized(settled: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A settled table, marked for broadcast only when it was counted to at most ``rows`` rows."""
    return F.broadcast(settled) if settled.limit(rows + 1).count() <= rows else settled


def few(df: DataFrame, rows: int, per: int = 100_000) -> DataFrame:
    """``df``, known to have about ``rows`` thin rows, in no more partitions than these ask for.

    Rounds over small tables would else write a file per partition and exchange.
    """
    return df.coalesce(max(1, -(-rows // per)))


# ---------------------------------------------------------------------------- Arrow text


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` over a task's batches. Spark keeps a worker for later tasks, also of other steps: at the end of
    a task it gives the memory that its arrays took back to the system (where the C library can)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task


def text_blocks(col: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a string column as ``(first row, end row, bytes, offsets)``; null is empty.

    A slice holds whole texts of about ``max_bytes`` together (one text at least), so the
    arrays computed from it stay small however many rows a batch has.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("") if len(col) else col.cast(pa.large_string())
    n = len(col)
    if not n:
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + max_bytes, "right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
