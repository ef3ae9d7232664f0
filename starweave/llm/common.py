"""Helpers shared by the operators: columns out of any frame, checked broadcasts, bounded Arrow slices."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space of the text contracts: \x20 and \x09-\x0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Bytes of text that the array code of a task works on at once.
SLICE_BYTES = 1 << 20


def text_of(column: str = "text"):
    """The column as text, null taken as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def checked_broadcast(side: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """``side`` marked for broadcast if it has at most ``max_rows`` rows, else as it is (a shuffled join, whose hot
    keys AQE splits). Only for narrow sides: a row is a key and a few numbers."""
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer over uint64, spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without a copy of the texts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at.astype(np.int64)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``limit`` bytes together; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def batches(rows: Iterable[pa.RecordBatch], fn) -> Iterator[pa.RecordBatch]:
    """Apply ``fn`` to every record batch that has rows."""
    for b in rows:
        if b.num_rows:
            yield fn(b)


def worker_state(key: str, make):
    """What ``make()`` returned the first time in this Python worker; it lives as long as the worker does."""
    import sys
    from types import ModuleType

    state = sys.modules.setdefault("starweave_worker_state", ModuleType("starweave_worker_state")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]
