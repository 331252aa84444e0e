"""Arrow batches in tasks: rows out in batches of bounded size, and memory given back when a task ends."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

ROWS = 64  # input rows made into Python objects at once
BYTES = 4 << 20  # of text in a batch that goes out; a single larger input row is not cut


def release() -> None:
    """Freed memory goes back to the system: workers are kept by Spark and stand idle between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def expanded(rows_of: Callable[..., Iterator[tuple]], schema: pa.Schema, most: int = BYTES):
    """The function for mapInArrow that makes rows of `schema` out of each input row, `rows_of` called with its cells."""

    def size(row: tuple) -> int:
        return 64 + sum(len(v) for v in row if isinstance(v, str))

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                for cells in zip(*(c.to_pylist() for c in batch.slice(lo, ROWS).columns)):
                    for row in rows_of(*cells):
                        rows.append(row)
                        held += size(row)
                        if held >= most:
                            yield made(rows)
                            rows, held = [], 0
        if rows:
            yield made(rows)
        del rows
        release()

    return run
