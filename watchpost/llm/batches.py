"""Small helpers for Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Lists of consecutive ``values``; ``counts`` has their lengths."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Tables of the consecutive rows with equal keys, from batches sorted by them.

    Many small runs come as one table: no run is ever cut, and one table holds at most the
    whole runs of one batch, or a single run that goes over several.
    """
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        edges = _edges(batch, keys)
        if pending and _row(pending[-1], keys, pending[-1].num_rows - 1) != _row(batch, keys, 0):
            yield pa.Table.from_batches(pending)
            pending = []
        if len(edges) > 1:  # the last run may go on
            yield pa.Table.from_batches([*pending, batch.slice(0, edges[-1])])
            pending = []
            batch = batch.slice(edges[-1])
        pending.append(batch)
    if pending:
        yield pa.Table.from_batches(pending)


def run_bounds(table: pa.Table, *keys: str) -> list[tuple[int, int]]:
    """Row ranges of the runs in a table that ``runs`` has given."""
    edges = _edges(table.combine_chunks().to_batches()[0], keys)
    return list(zip(edges.tolist(), [*edges[1:].tolist(), table.num_rows]))


def _row(batch: pa.RecordBatch, keys: tuple[str, ...], i: int) -> tuple:
    return tuple(batch.column(k)[i].as_py() for k in keys)


def _edges(batch: pa.RecordBatch, keys: tuple[str, ...]) -> np.ndarray:
    """Where a run begins, 0 included."""
    changed = np.zeros(batch.num_rows, bool)
    changed[0] = True
    for k in keys:
        column = batch.column(k)
        changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)
