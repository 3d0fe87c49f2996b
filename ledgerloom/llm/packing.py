"""Best-fit decreasing packing of token pieces into sequences.

Lengths are whole numbers up to the capacity, so rows of one length are
interchangeable. The table is counted by length, and best-fit decreasing runs
over those counts: for each length, longest first, a segment tree over the
remaining capacities gives the tightest open bin in logarithmic time, and all
bins in that state take their rows at once. The outcome is the one that placing
row after row would give, yet the plan has at most capacity squared entries,
whatever the number of rows. Rows find their place by their rank among the rows
of their length: a count per task, summed over tasks, plus the rank inside the
task. No sort and no group of one length is ever gathered.

Cases: NULL and empty texts are the end id alone. Rows whose length is NULL or
outside 1..capacity get a NULL place. Repeated rows are packed each. An empty
table stays empty. Columns of other names pass through; ``_task`` and ``_slot``
are reserved and refused.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ledgerloom.llm.byte_ids import encoder
from ledgerloom.llm.common import bounded_batches, slices, table, tidy
from ledgerloom.session import stored

ENCODE_BYTES = 2 << 20
#: Words kept per worker where pieces are numbered as they are cut: such a stage has two workers per core.
KEPT_WORDS = 300_000
#: The same where pieces are stored first, so that a core has one worker, and its words serve all texts of the core.
KEPT_WORDS_ALONE = 700_000


class CapacityTree:
    """Which remaining capacities have open bins; finds the smallest one that fits."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        i = capacity + self.leaves
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, length: int) -> int | None:
        """Smallest capacity of at least ``length`` with an open bin."""
        i = length + self.leaves
        if self.open[i]:
            return length
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over counts by length.

    Returns runs (length, first rank, first bin, rows per bin, offset) and the
    number of bins. The rows of a run fill bins one after the other.
    """
    tree, bins = CapacityTree(capacity), defaultdict(list)
    runs, n_bins = [], 0

    def put(left: int, first: int, count: int) -> None:
        if count and left:
            bins[left].append((first, count))
            tree.set(left, True)

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            left = tree.tightest(length)
            if left is None:
                left, first, count = capacity, n_bins, -(-rest // (capacity // length))
                n_bins += count
            else:
                first, count = bins[left].pop()
                if not bins[left]:
                    tree.set(left, False)
            each = left // length
            full = min(count, rest // each)
            taken = full * each
            if full < count and taken < rest:
                partial = rest - taken
                put(left - partial * length, first + full, 1)
                put(left, first + full + 1, count - full - 1)
                taken = rest
            else:
                put(left, first + full, count - full)
            put(left - each * length, first, full)
            runs.append((length, rank, first, each, capacity - left))
            rank += taken
            rest -= taken
    return runs, n_bins


def best_fit(rows: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """``rows`` with sequence_id and offset: each sequence holds at most ``capacity``."""
    if clash := {"_task", "_slot", "sequence_id", "offset"} & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} are reserved")
    spark = rows.sparkSession
    bounded_batches(spark)
    at = rows.columns.index(length)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, used = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = batch.column(at).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            sizes = np.where((sizes < 1) | (sizes > capacity), 0, sizes)
            order = np.argsort(sizes, kind="stable")
            ranked = sizes[order]
            first = np.searchsorted(ranked, ranked)
            slot = np.empty(len(sizes), np.int64)
            slot[order] = np.arange(len(sizes)) - first + used[ranked]
            used += np.bincount(sizes, minlength=capacity + 1)
            columns = [*batch.columns, pa.array(np.full(len(sizes), task, np.int32)), pa.array(slot)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_task", "_slot"])

    schema = StructType([*rows.schema.fields, StructField("_task", IntegerType()), StructField("_slot", LongType())])
    kept = stored(rows.mapInArrow(number, schema), "pieces")
    size = F.col(length).cast("long")
    fits = size.between(1, capacity)
    counts = stored(kept.where(fits).groupBy("_task", size.alias("_size")).agg(F.count("*").alias("_n")), "counts")
    total = {r["_size"]: r["n"] for r in counts.groupBy("_size").agg(F.sum("_n").alias("n")).collect()}
    runs, _ = plan_bins(total, capacity)
    runs.sort()
    plan = spark.sparkContext.broadcast(np.array(runs, np.int64).reshape(-1, 5))
    before = F.sum("_n").over(Window.partitionBy("_size").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("_task", "_size", F.coalesce(before, F.lit(0).cast("long")).alias("_base"))
    ranked = kept.join(bases, (kept["_task"] == bases["_task"]) & (size == bases["_size"]), "left").select(
        *[kept[f"`{c}`"] for c in rows.columns], (F.col("_slot") + F.col("_base")).alias("_rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_of = plan.value
        keys = (table_of[:, 0] << 44) + table_of[:, 1]
        for batch in batches:
            rank_column = batch.column(len(batch.columns) - 1)
            null = rank_column.is_null().to_numpy(zero_copy_only=False)
            rank = rank_column.fill_null(0).to_numpy(zero_copy_only=False)
            sizes = batch.column(at).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            sizes = np.where(null, 0, sizes)
            run = np.searchsorted(keys, (sizes << 44) + rank, side="right") - 1
            _, first, start, each, offset = table_of[run].T if len(table_of) else np.ones((5, len(rank)), np.int64)
            j = rank - first
            out = [start + j // each, offset + j % each * sizes]
            columns = [*batch.columns[:-1], *(pa.array(c, pa.int64(), mask=null) for c in out)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    out = StructType([*rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.mapInArrow(place, out)


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, kept_words: int = KEPT_WORDS) -> DataFrame:
    """Token pieces of whole documents: doc_id, piece, start, length, ids (little-endian unsigned 32-bit).

    A document is its ids and ``end_id``. One that is longer than the capacity
    is cut into full pieces; what is left over comes first. A worker keeps the
    ids of about ``kept_words`` words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(vocabulary, kept_words)
        for batch in batches:
            names, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices(list(map(len, texts)), ENCODE_BYTES):
                ids, at = codec.encode(texts[a:b])
                ids, at = np.insert(ids, at[1:], end_id).astype("<u4"), at + np.arange(len(at))
                n = np.diff(at)
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = n - (pieces - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                cuts = np.append(at[:-1][doc] + start, len(ids)).astype(np.int32) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        names.slice(a, b - a).take(pa.array(doc)),
                        pa.array(piece, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(cuts), pa.py_buffer(ids)]),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        tidy(run, keeps=True), "doc_id long, piece int, start long, length long, ids binary"
    )


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    pieces = cut_pieces(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", 1024, 2, KEPT_WORDS_ALONE)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return best_fit(stored(digests, "digests"), 1024)
