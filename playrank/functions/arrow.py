"""List columns to and from numpy without a Python object per row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def flat(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """All list values one after the other."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as float64 rows."""
    return flat(column).astype(np.float64).reshape(len(column), -1)


def lengths(column: pa.Array) -> np.ndarray:
    """Length of each list, 0 for null."""
    return column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def list_column(rows: np.ndarray) -> pa.ListArray:
    """Matrix rows as a list column."""
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32) if rows.size else np.zeros(len(rows) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


def pack(rows: np.ndarray) -> pa.BinaryArray:
    """Matrix rows as float32 bytes: one value per row to store and shuffle instead of many."""
    data = np.ascontiguousarray(rows, dtype=np.float32)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (data.shape[1] * data.itemsize)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpack(column: pa.Array) -> np.ndarray:
    """Packed rows as a float64 matrix."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data.tobytes(), dtype=np.float32).astype(np.float64).reshape(len(column), -1)


def sum_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum packed rows (key, vec, parts) per key within a partition that holds all rows of its keys."""
    keys = np.empty(0, np.int64)
    sums, parts = None, np.empty(0, np.int64)
    for batch in batches:
        values = unpack(batch.column("vec"))
        stacked = values if sums is None else np.vstack([sums, values])
        names = np.concatenate([keys, batch.column("key").to_numpy()])
        counts = np.concatenate([parts, batch.column("parts").to_numpy()])
        order = np.argsort(names, kind="stable")
        keys, starts = np.unique(names[order], return_index=True)
        sums, parts = np.add.reduceat(stacked[order], starts), np.add.reduceat(counts[order], starts)
    if len(keys):
        yield pa.RecordBatch.from_arrays([pa.array(keys), pack(sums), pa.array(parts)], ["key", "vec", "parts"])


def part_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(part, all its rows) from batches in which the rows of a part follow each other.

    A part is put together whole, so what is made of it depends neither on how Arrow cuts
    batches nor on which parts share a task.
    """
    current, held = None, []

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        parts = batch.column("part").to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)] if len(parts) else []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if held and parts[a] != current:
                yield current, whole()
                held = []
            current = int(parts[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield current, whole()
