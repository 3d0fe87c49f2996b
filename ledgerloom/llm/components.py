"""Connected components of link tables, by rounds of star contraction in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import stored

EDGES = "a long, b long"


class Forest:
    """Union-find over dense numbers; the smallest member is the root."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        if x < y:
            self.parent[y] = x
        else:
            self.parent[x] = y
        return True


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, smallest member) that connect what the given edges connect."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    forest = Forest(len(names))
    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
        forest.join(x, y)
    roots = np.fromiter(map(forest.root, range(len(names))), np.int64, len(names))
    own = roots != np.arange(len(names))
    return names[own], names[roots[own]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a task, a bounded number at a time, by a spanning forest."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a, b = np.concatenate([a, batch.column(0).to_numpy()]), np.concatenate([b, batch.column(1).to_numpy()])
        if len(a) > 500_000:
            a, b = spanning(a, b)
            if len(a) > 250_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(a):
        a, b = spanning(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b). Nodes without an edge are left out.

    Rounds of large-star and small-star, each a minimum per node (combined
    before the shuffle) and an equi-join, until every node points to its
    component's smallest one. Only two numbers per round reach the driver.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.mapInArrow(_contract, EDGES), "links")
    for _ in range(max_rounds):
        # Large star: larger neighbours go to the smallest neighbour.
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
        # Small star: smaller neighbours and the node itself go to the smallest of them.
        large = stored(large.where("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("_m")).withColumnRenamed("a", "_a")
        near = large.join(least, F.col("a") == F.col("_a"))
        small = near.select(F.col("b").alias("a"), F.col("_m").alias("b")).union(near.select("a", F.col("_m").alias("b")))
        links = stored(small.where("a <> b").distinct(), "links")
        # Stars: no node has two smaller neighbours, and no centre has one.
        centres = links.select(F.col("b").alias("c")).distinct()
        n, nodes = links.agg(F.count("*"), F.count_distinct("a")).first()
        if n == nodes and links.join(centres, F.col("a") == F.col("c"), "left_semi").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres.select("c", "c"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
