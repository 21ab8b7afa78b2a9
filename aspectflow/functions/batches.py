"""Record batches cut by bytes: what a kernel holds at once depends neither on rows a batch nor on the table's size.
And memory that a kernel has freed goes back to the system."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
GIVEN_BACK = 16         # batches out after which a kernel gives memory back


def give_back() -> None:
    """Give freed memory back to the system.  A Python worker outlives its task, and the C library and Arrow keep what
    was freed, up to a task's peak, which counts against the executor in all later stages.  Without glibc only Arrow's goes."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``kernel``, for mapInArrow, that gives its memory back every ``GIVEN_BACK`` batches and when it ends."""
    @wraps(kernel)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, out in enumerate(kernel(batches), 1):
            yield out
            if i % GIVEN_BACK == 0:
                give_back()
        give_back()

    return run


def _sizes(column: pa.Array) -> np.ndarray:
    """Bytes of each row of a text column, or of a column of lists of integers."""
    import pyarrow.compute as pc

    if pa.types.is_list(column.type):
        return 4 * np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
    return np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)


def pieces(batch: pa.RecordBatch, column: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices, in order, whose ``column`` holds ``size`` bytes at most (or one row); an empty batch as it is."""
    ends = np.cumsum(_sizes(batch[column]))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + size, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop
    if not batch.num_rows:
        yield batch
