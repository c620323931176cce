"""Shared by the vector operators: which vectors count, and sorted tiles in bounded memory."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, finite in all components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype, copy=False)


def whole_tiles(batches: Iterator[pa.RecordBatch], key: str = "tile") -> Iterator[pa.Table]:
    """The rows of one tile at a time; rows arrive sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at, keys = 0, batch.column(key).to_numpy()
        edges = [*np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        for edge in edges:
            part = batch.slice(at, edge - at)
            if not part.num_rows:
                continue
            if held and held[-1].column(key)[0] != part.column(key)[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            at = edge
    if held:
        yield pa.Table.from_batches(held)
