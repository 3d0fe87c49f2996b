"""Vectors in and out of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str | Column) -> Column:
    """Whether a vector is neither NULL, empty nor zero, and all its components are finite numbers."""
    v = F.col(column) if isinstance(column, str) else column
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and the vector as doubles."""
    return df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths.tolist()}")
    return flat.reshape(len(column), -1)


def binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    width = rows.shape[1] * rows.itemsize if len(rows) else 0
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))]
    )


def from_binary(column: pa.Array, dtype) -> np.ndarray:
    """Inverse of :func:`binary`."""
    rows = [np.frombuffer(v.as_buffer(), dtype) for v in column]
    return np.stack(rows) if rows else np.zeros((0, 0), dtype)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, the same whatever the block they are computed in."""
    return np.einsum("ij,ij->i", a, b)
