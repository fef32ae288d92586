"""What the operators with Arrow code share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_ROWS = 4096
SLICE_BYTES = 16 << 20


def slices(
    batches: Iterator[pa.RecordBatch], text: str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice has few rows and, unless it is a single row, little text.

    Where a batch is cut depends on its rows only.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            skipped = ends[at - 1] if at else 0
            end = int(np.searchsorted(ends, skipped + size, side="right"))
            end = min(max(end, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def release_memory() -> None:
    """Give freed memory back to the system: workers live on after a task, and others beside them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The UTF-8 bytes of a text column; a null text is empty."""
    for value in batch.column(name).cast(pa.binary()):
        yield value.as_py() or b""


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores until no column is called so; Spark does not tell cases apart."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name
