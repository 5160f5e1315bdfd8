"""Helpers for embedding columns: validity, Arrow lists to arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """True for a vector that is not null, not empty, not zero, and has finite components only."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(embedding) > 0) & ~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def packed(rows: np.ndarray, kind) -> pa.Array:
    """Each row's bytes, as a binary column."""
    rows = np.ascontiguousarray(rows, dtype=kind)
    width = rows.shape[1] * rows.dtype.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def unpacked(values, kind) -> np.ndarray:
    """The rows of a column of such bytes."""
    values = list(values)
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), -1)
