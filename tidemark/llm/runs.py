"""Rows that share a key, out of a partition sorted by it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def complete_runs(
    batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], singles: bool = False
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """(columns, starts) with whole runs of equal ``keys`` only; the last run of a batch waits for the next one.

    ``starts`` has one more entry than there are runs. Runs of one row are left out unless ``singles`` is set.
    """
    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if kept is not None:
            rows = pa.concat_tables([kept, rows])
        changes = _changes(rows, keys)
        if not len(changes):
            kept = rows
            continue
        end = int(changes[-1])
        kept = rows.slice(end)
        yield from _runs(rows.slice(0, end), changes[:-1], singles)
    if kept is not None:
        yield from _runs(kept, _changes(kept, keys), singles)


def _changes(rows: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Places where a row differs from the one before."""
    differs = np.zeros(max(rows.num_rows - 1, 0), bool)
    for key in keys:
        values = rows.column(key).to_numpy()
        differs |= values[1:] != values[:-1]
    return np.flatnonzero(differs) + 1


def _runs(rows: pa.Table, changes: np.ndarray, singles: bool) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    starts = np.concatenate([[0], changes, [rows.num_rows]]).astype(np.int64)
    sizes = np.diff(starts)
    least = 0 if singles else 1
    many = np.repeat(sizes > least, sizes)
    if not many.any():
        return
    rows = rows.filter(pa.array(many))
    yield (
        {name: rows.column(name).to_numpy(zero_copy_only=False) for name in rows.column_names},
        np.concatenate([[0], np.cumsum(sizes[sizes > least])]),
    )


def with_neighbours(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted partition whose ``key`` is also that of the row before or behind.

    One row is kept from batch to batch, however many share a key.
    """
    kept: pa.RecordBatch | None = None
    taken = False
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        equal = values[1:] == values[:-1]
        wanted = np.zeros(len(values), bool)
        wanted[1:] |= equal
        wanted[:-1] |= equal
        if kept is not None and kept.column(key)[0].as_py() == values[0]:
            if not taken:
                yield kept
            wanted[0] = True
        yield batch.filter(pa.array(wanted))
        kept, taken = batch.slice(batch.num_rows - 1), bool(wanted[-1])
