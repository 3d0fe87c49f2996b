"""Fixed-size bitmaps of 64-bit numbers: a filter that may pass too much, never too little."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import mix

BITS = 26
MISSING = (1 << 63) - 1


def _slots(values: np.ndarray) -> np.ndarray:
    return (mix(values.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """2**26 bits (8 MB, whatever the input). The driver gets at most 2**20 words of them."""
    def slots(batches):
        for batch in batches:
            slot = np.unique(_slots(batch.column(0).to_numpy()))
            word, at = np.unique(slot >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (slot & 63).astype(np.uint64), at) if len(slot) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    value: Column = F.col(column).cast("long").alias("v")
    rows = df.select(value).where("v IS NOT NULL").mapInArrow(slots, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = rows.toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def rows_that_may_match(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among ``keys``, so that a join shuffles few others. NULL never is."""
    bits = df.sparkSession.sparkContext.broadcast(bitmap(keys, key))
    at = df.columns.index(column)

    def run(batches):
        for batch in batches:
            values = batch.column(at)
            held = may_hold(bits.value, values.fill_null(0).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(held & values.is_valid().to_numpy(zero_copy_only=False)))

    return df.mapInArrow(run, df.schema)


def may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = _slots(values)
    return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0
