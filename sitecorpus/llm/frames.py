"""Small helpers for operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sitecorpus.functions.batches import release


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a longer one if `df` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


ROWS = 512  # handled at once, so that a batch's texts are never all held a second time


_kept: dict[object, object] = {}
_asked: set[object] = set()


def kept(name: object, make: Callable[[], object]):
    """What a worker keeps from task to task under a name, for as long as the tasks that it is given ask for it."""
    _asked.add(name)
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    """What earlier tasks have kept and nothing has asked for since goes, and its memory goes back to the system."""
    others = _kept.keys() - _asked
    _asked.clear()
    if others:
        for name in others:
            del _kept[name]
        release()


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows. Before them goes what earlier tasks have kept and this one has not asked for; at the
    end, memory that the task has freed goes back to the system: workers are kept by Spark, and several operators may
    follow each other in one."""
    forget()
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)
    release()


def per_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]]):
    """The function for mapInArrow that handles a few rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            made = function(batch)
            yield from [made] if isinstance(made, pa.RecordBatch) else made

    return run


def bounded(rows: DataFrame, most: int, key: Column) -> DataFrame:
    """About `most` of the rows, or all if there are fewer, by a hash of the key: the same ones every time."""
    share = min(1.0, most / max(1, rows.count()))
    return rows if share == 1.0 else rows.filter(F.pmod(F.xxhash64(key.cast("string")), F.lit(1_000_000)) < int(share * 1_000_000))


def crc_mod(key: Column, n: int) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(n))


def row_key(id_col: Column, text: Column) -> Column:
    """A 128-bit name of a row by its id and text. Unlike a row's place it is the same whenever and however a table is
    read, so that steps can be joined on it; only rows that are repeated as a whole share it."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(part(id_col), F.lit(":"), part(text))))
