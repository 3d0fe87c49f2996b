"""Exchange of many small numbers between tasks as a few large rows.

A row per number would cost more in row headers than in data. A task sorts its
numbers by bucket and sends one row per bucket with the columns as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


class Outbox:
    """Collects columns by bucket and gives them out in rows (bucket, c0, c1, ...)."""

    def __init__(self, n_buckets: int, kinds: list[str], rows: int = 1 << 20) -> None:
        self.n_buckets, self.kinds, self.rows = n_buckets, kinds, rows
        self.held: list[tuple] = []
        self.count = 0

    def put(self, bucket: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((bucket, *columns))
        self.count += len(bucket)
        if self.count >= self.rows:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            bucket, *columns = (np.concatenate(c) for c in zip(*self.held, strict=True))
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(at[1:], len(bucket))
            out = [pa.array(bucket[at], pa.int32())]
            for column, kind in zip(columns, self.kinds, strict=True):
                data = column[order].astype(kind, copy=False)
                out.append(pa.array([data[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=["bucket", *(f"c{i}" for i in range(len(columns)))])
        self.held, self.count = [], 0


def by_bucket(rows: DataFrame, n_buckets: int) -> DataFrame:
    """One partition per bucket."""
    return rows.repartitionById(n_buckets, "bucket")


def received(batches: Iterator[pa.RecordBatch], kinds: list[str]) -> list[np.ndarray]:
    """All columns of the rows of a task, each in one array."""
    parts: list[list] = [[np.zeros(0, kind)] for kind in kinds]
    for batch in batches:
        for i, kind in enumerate(kinds):
            parts[i] += [np.frombuffer(v.as_buffer(), kind) for v in batch.column(f"c{i}")]
    return [np.concatenate(p) for p in parts]
