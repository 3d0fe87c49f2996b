"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import json
import os
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, limit: str = "8m") -> None:
    """Hand tasks Arrow batches of ``limit`` bytes at most, unless the session says otherwise.

    Rows hold whole texts, and a batch lives in the executor and in its Python
    worker at once; Spark's own bound of 64 MB would cost hundreds per core.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, limit)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; imported late, as it exists on workers too."""
    import public_tokenizers

    return public_tokenizers.path(name)


def one_thread() -> None:
    """A task uses one core; native libraries must not start more threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a folder on storage that all tasks share."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_whole(fs: pafs.FileSystem, path: str, chunks: Iterator[bytes]) -> int:
    """Write a file under a name of its own and move it into place at the end.

    A task that is lost or run twice leaves either nothing or the same whole
    file under the final name.
    """
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    size = 0
    with fs.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    fs.move(part, path)
    return size


def release() -> None:
    """Give memory that is no longer used back to the system; worker processes live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


#: What a worker process keeps between tasks, as functions that drop it.
KEPT: list = []


def drop_kept() -> None:
    for drop in KEPT:
        drop()


def tidy(run, keeps: bool = False):
    """A function over batches that gives memory back at its end.

    Worker processes are shared by all tasks of a session; unless it ``keeps``
    them, the function drops what earlier ones have kept there.
    """

    @functools.wraps(run)
    def wrapped(batches):
        if not keeps:
            drop_kept()
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def slices(sizes: Sequence[int], budget: int) -> Iterator[tuple[int, int]]:
    """Cut rows into consecutive runs of at most ``budget`` bytes (one row at least)."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > budget:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> _S33)
    h = h * _MIX_A
    h ^= h >> _S33
    h *= _MIX_B
    h ^= h >> _S33
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 places where rows start. NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), at - (at[0] if len(at) else 0)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def byte_sizes(column: pa.Array) -> list[int]:
    """UTF-8 bytes of each row, without a copy of the texts. NULL is empty."""
    return pc.binary_length(column).fill_null(0).to_pylist()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``[start, start + length)``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def pair_runs(after: np.ndarray, at_once: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs of rows whose pairs (``after`` of each row) are about ``at_once``; none without pairs."""
    total = int(after.sum())
    if total:
        steps = np.searchsorted(np.cumsum(after), np.arange(0, total + at_once, at_once))
        yield from zip(steps[:-1].tolist(), [*steps[1:-1].tolist(), len(after)], strict=True)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch; numpy columns are taken without a Python loop."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def packed(value: dict) -> bytes:
    return json.dumps(value, sort_keys=True).encode()
