"""Exact nearest neighbours by inner product: a block matrix join over int8 codes.

Vectors are dealt evenly into blocks. A block keeps its vectors as doubles, as
int8 codes with one scale per vector, and the largest rounding error of each.
A tile is one block of queries against one block of candidates: the product of
the codes is exact, and scale and errors bound how far the true inner product
can be from it. A pair whose upper bound is below the query's k-th best so far
cannot matter; the others are computed again in doubles. A task goes through
one block of queries and one of ``GROUPS`` groups of candidate blocks, and
merges each tile into a heap per query. So a query leaves as many short lists
as there are groups, however many rows there are; Spark merges those.

With q = sq*cq + eq and x = sx*cx + ex:
|q.x - sq*sx*(cq.cx)| <= |eq|*|x| + |q|*|ex| + |eq|*|ex|.

Tiles are found by an equi-join on (query block, candidate group), whose keys
are equally large, so no key is hot. The work is the stated query set against
all rows; neither side is broadcast.

Cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part. Fewer than k candidates: all are returned. Ties go to
the smaller vec_id. Rows of a query's own vec_id are not its neighbours. Whole
repeats of a row count once; other rows of one vec_id are separate candidates.
Rows without vec_id take no part. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, table
from ledgerloom.llm.vectors import dots, matrix, usable, vectors
from ledgerloom.session import stored

BLOCK_ROWS = 2048
GROUPS = 8
BLOCK = "block int, n int, ids binary, rows binary, codes binary, scales binary, errors binary"
#: Covers the rounding of the double arithmetic in the bounds themselves.
SLACK = 1e-9


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and length of the rounding error of each row."""
    scale = np.abs(rows).max(axis=1) / 127.0
    codes = np.rint(rows / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(rows - codes * scale[:, None], axis=1)


def blocks(df: DataFrame, block_rows: int) -> DataFrame:
    """One row per block; blocks are numbered from 0 and equally large."""
    n = df.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []
        for batch in batches:
            if batch.num_rows:
                ids.append(batch.column("vec_id").to_numpy())
                rows.append(matrix(batch.column("vector")))
        if not ids:
            return
        ids, rows = np.concatenate(ids), np.concatenate(rows)
        codes, scales, errors = quantise(rows)
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "n": pa.array([len(ids)], pa.int32()),
                **{
                    name: pa.array([value.tobytes()], pa.binary())
                    for name, value in (("ids", ids), ("rows", rows), ("codes", codes), ("scales", scales), ("errors", errors))
                },
            }
        )

    return stored(df.repartition(max(1, -(-n // block_rows))).mapInArrow(run, BLOCK), "blocks")


class Block:
    def __init__(self, row: dict, side: str) -> None:
        take = lambda name, kind: np.frombuffer(row[f"{side}_{name}"], kind)
        n = row[f"{side}_n"]
        self.ids, self.scales, self.errors = take("ids", np.int64), take("scales", np.float64), take("errors", np.float64)
        self.rows = take("rows", np.float64).reshape(n, -1)
        self.codes = take("codes", np.int8).reshape(n, -1).astype(np.float32)
        self.lengths = np.linalg.norm(self.rows, axis=1)


class Best:
    """The k best hits of each query of a block so far, as heaps whose top is the worst of them."""

    def __init__(self, queries: Block, k: int) -> None:
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        self.least = np.full(len(queries.ids), -np.inf)

    def add(self, candidates: Block) -> None:
        """Merge one tile."""
        q, k = self.queries, self.k
        # Products of int8 codes are whole numbers below 2**24 up to 1,040 dimensions, so single precision holds them exactly.
        kind = np.float32 if q.codes.shape[1] <= 1040 else np.float64
        product = q.codes.astype(kind) @ candidates.codes.astype(kind).T
        about = product * q.scales[:, None] * candidates.scales
        margin = (
            q.errors[:, None] * candidates.lengths + q.lengths[:, None] * candidates.errors + q.errors[:, None] * candidates.errors
        ) * (1 + SLACK) + SLACK * q.lengths[:, None] * candidates.lengths
        own = q.ids[:, None] == candidates.ids
        low = np.where(own, -np.inf, about - margin)
        bound = self.least
        if low.shape[1] > k:
            bound = np.maximum(bound, np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k])
        i, j = np.nonzero((about + margin >= bound[:, None]) & ~own)
        score = dots(q.rows[i], candidates.rows[j])
        kept = score >= self.least[i]
        i, j, score = i[kept], j[kept], score[kept]
        for at, hit in zip(i.tolist(), zip(score.tolist(), (-candidates.ids[j]).tolist(), strict=True), strict=True):
            heap = self.heaps[at]
            if len(heap) < k:
                heapq.heappush(heap, hit)
            elif hit > heap[0]:
                heapq.heapreplace(heap, hit)
        for at in np.unique(i).tolist():
            if len(self.heaps[at]) == k:
                self.least[at] = self.heaps[at][0][0]

    def rows(self) -> Iterator[pa.RecordBatch]:
        hits = [(query, -minus, score) for query, heap in zip(self.queries.ids.tolist(), self.heaps, strict=True) for score, minus in heap]
        if hits:
            query, vec_id, score = zip(*hits, strict=True)
            yield pa.RecordBatch.from_pydict(
                {"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(vec_id, pa.int64()), "score": pa.array(score, pa.float64())}
            )


def nearest(df: DataFrame, is_query: Column, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of every query row."""
    rows = vectors(df).where(F.col("vec_id").isNotNull() & usable("vector")).dropDuplicates(["vec_id", "vector"])
    bounded_batches(df.sparkSession)
    every = blocks(rows, block_rows)
    asked = blocks(rows.where(is_query), block_rows)
    names = [f.split()[0] for f in BLOCK.split(", ")]
    n_asked = asked.agg(F.coalesce(F.max("block"), F.lit(-1))).first()[0] + 1
    numbers = lambda n: F.sequence(F.lit(0), F.lit(n - 1)) if n else F.array().cast("array<int>")
    left = asked.select(*[F.col(n).alias(f"q_{n}") for n in names], F.explode(numbers(GROUPS)).alias("_group"))
    right = every.select(*[F.col(n).alias(f"c_{n}") for n in names], F.explode(numbers(n_asked)).alias("_for"))
    tiles = left.join(right, (F.col("q_block") == F.col("_for")) & (F.col("_group") == F.col("c_block") % GROUPS)).drop("_for")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                own = (row["q_block"].as_py(), row["_group"].as_py())
                if own != key:
                    if best:
                        yield from best.rows()
                    key, best = own, Best(Block({n: v.as_py() for n, v in row.items() if n[:2] == "q_"}, "q"), k)
                best.add(Block({n: v.as_py() for n, v in row.items() if n[:2] == "c_"}, "c"))
        if best:
            yield from best.rows()

    found = tiles.mapInArrow(run, "query_id long, vec_id long, score double")
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_block_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
