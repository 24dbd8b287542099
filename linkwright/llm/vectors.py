"""Whole-number vectors from a column of number arrays, shared by the vector operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """The vector is there, and every component of it is a finite number."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                               & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def width_of(vectors: DataFrame, column: str) -> int:
    """The longest vector's number of components (0 without rows); shorter vectors count as padded with zeros."""
    return vectors.agg(F.coalesce(F.max(F.size(column)), F.lit(0)).alias("n")).first()["n"]


def largest(width: int) -> int:
    """Components are held to +-this, so that a sum of ``width`` squared differences stays below 2^62."""
    return int(min((1 << 30) - 1, np.sqrt((1 << 62) / max(1, width)) // 2))


def whole_numbers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of ``floor(scale * component)`` (int32), padded with zeros to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    offsets = np.asarray(column.offsets)
    flat = np.asarray(column.values.cast(pa.float64()), dtype=np.float64)[offsets[0]:offsets[-1]]
    sizes = np.diff(offsets)
    out = np.zeros((n, width), dtype=np.int32)
    top = largest(width)
    with np.errstate(over="ignore"):  # what leaves the range is held to it
        found = np.clip(np.floor(flat * scale), -top, top).astype(np.int32)
    at = np.repeat(np.arange(n), sizes)
    out[at, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = found
    return out


def packed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    rows = np.ascontiguousarray(rows)
    step = rows.shape[1] * rows.itemsize if rows.ndim > 1 else rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * step
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())]
                                            ).cast(pa.binary())


def unpacked(column: pa.Array, dtype, width: int) -> np.ndarray:
    """The rows that ``packed`` made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = (data.to_pybytes() if data is not None else b"")[offsets[0]:offsets[-1]] if len(column) else b""
    return np.frombuffer(raw, dtype=dtype).reshape(len(column), width)


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches regrouped into tables of ``rows`` rows; the last may have fewer."""
    held, n = [], 0
    for batch in batches:
        while n + batch.num_rows >= rows:
            held.append(batch.slice(0, rows - n))
            batch = batch.slice(rows - n)
            yield pa.Table.from_batches(held)
            held, n = [], 0
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)
