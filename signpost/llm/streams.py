"""Helpers for Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of equal `keys` of batches that come sorted by them.

    A group is held whole, so the caller must have bounded its size.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        columns = [table.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns))
        ends = [i for i in range(1, len(rows)) if rows[i] != rows[i - 1]]
        start = 0
        for end in ends:
            yield table.slice(start, end - start)
            start = end
        held = table.slice(start)
    if held is not None and held.num_rows:
        yield held


def binary_arrays(column: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype) for v in column.to_pylist()]
