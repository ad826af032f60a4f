"""Helpers for functions that run inside ``mapInArrow``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Rows handled at once inside a task; a batch from Spark may hold more.
STEP = 512

# A-Z to a-z, every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def steps(batches: Iterator[pa.RecordBatch], rows: int = STEP) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most `rows` rows; empty ones go."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def byte_steps(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut where the texts of `column` exceed `most` bytes; a longer text stands alone."""
    for batch in batches:
        sizes = np.fromiter((n or 0 for n in pc.binary_length(batch.column(column)).to_pylist()), dtype=np.int64)
        ends = np.cumsum(sizes)
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])


def texts(column: pa.Array) -> list[str]:
    """A string column as Python texts; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def text_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8; null counts as empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]
