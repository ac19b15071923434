"""Bounds on the memory of Python tasks: slices of bounded text, and memory given back at the end."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_ROWS = 1000
SLICE_BYTES = 4 << 20


@cache
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system at a task's end: the worker lives on, and what it keeps counts beside other operators' tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim() is not None:
        _trim()(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of at most ``rows`` rows and about ``size`` bytes in ``column``; a longer text is a slice by itself."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            end = min(at + rows, max(at + 1, int(np.searchsorted(upto, before + size, side="right"))))
            yield batch.slice(at, end - at)
            at = end
