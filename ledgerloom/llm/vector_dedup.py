"""Near-duplicates among vectors by cross-polytope hashing.

Each table applies two pseudo-random rotations (three rounds of sign flips and
a fast Hadamard transform) and names a vector by the nearest signed axis of
each. A vector is stored under its own bucket and looks into the two next
nearest as well. Pairs that share a bucket are candidates and are verified by
cosine in doubles, so no link is wrong; a pair of cosine 0.9 is missed with a
probability of about 0.4 % (64 dimensions, eight tables), a closer one less.

Equal vectors are one class and one row. A pair may meet in many buckets: each
row carries its bucket names of all tables, and a link counts only where the
pair meets first, so no list of pairs is shuffled or made distinct. Buckets
give degrees per vector and a spanning forest of their links, never all pairs.
A bucket of more than ``tile_rows`` rows is cut into tiles; each pair of tiles
is a task's group of its own, so nothing is capped.

Cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components link with nothing (0 links, own component). Equal vectors link, also
if rows repeat whole; those link with each other too. Rows without vec_id are
left out. Other columns are not read. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, pair_runs, ragged, table
from ledgerloom.llm.components import components, spanning
from ledgerloom.llm.vectors import dots, matrix, usable, vectors
from ledgerloom.session import stored

TABLES, ROTATIONS, PROBES = 8, 2, 2
TILE_ROWS = 2048
PAIRS_AT_ONCE = 1 << 18
LINKS = "node long, other long, links long"


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = rows.shape
    half = 1
    while half < width:
        rows = rows.reshape(n, width // (2 * half), 2, half)
        rows = np.stack([rows[:, :, 0] + rows[:, :, 1], rows[:, :, 0] - rows[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return rows


def rotate(rows: np.ndarray, seed: int) -> np.ndarray:
    random = np.random.default_rng(seed)
    for _ in range(3):
        rows = hadamard(rows * random.choice([-1.0, 1.0], rows.shape[1])) / np.sqrt(rows.shape[1])
    return rows


def bucket_names(rows: np.ndarray) -> np.ndarray:
    """Names of shape (rows, tables, 1 + probes): the own bucket first, then the next nearest."""
    n, width = rows.shape
    size = max(2, 1 << (width - 1).bit_length())
    rows = np.pad(rows / np.linalg.norm(rows, axis=1, keepdims=True), ((0, 0), (0, size - width)))
    names = np.zeros((n, TABLES, 1 + PROBES), np.int64)
    every = np.arange(n)
    for t in range(TABLES):
        axes, loss = np.zeros((n, ROTATIONS, 2), np.int64), np.zeros((n, ROTATIONS))
        for r in range(ROTATIONS):
            turned = rotate(rows, 1 + t * ROTATIONS + r)
            away = np.abs(turned)
            first = away.argmax(axis=1)
            most = away[every, first]
            away[every, first] = -1
            second = away.argmax(axis=1)
            for i, axis in enumerate((first, second)):
                axes[:, r, i] = 2 * axis + (turned[every, axis] < 0)
            loss[:, r] = most - away[every, second]
        cheap = np.argsort(loss, axis=1, kind="stable")
        for p in range(1 + PROBES):
            chosen = axes[:, :, 0].copy()
            if p:
                turn = cheap[:, p - 1]
                chosen[every, turn] = axes[every, turn, 1]
            name = np.zeros(n, np.int64)
            for r in range(ROTATIONS):
                name = name * (2 * size) + chosen[:, r]
            names[:, t, p] = name
    return names


def first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where pairs meet first, as table << 48 | bucket, from their bucket names."""
    into_a = (b[:, :, :1] == a).any(axis=2)
    into_b = (a[:, :, :1] == b).any(axis=2)
    none = np.int64(1 << 47)
    bucket = np.minimum(np.where(into_a, b[:, :, 0], none), np.where(into_b, a[:, :, 0], none))
    t = (bucket < none).argmax(axis=1)
    return (t.astype(np.int64) << 48) | bucket[np.arange(len(t)), t]


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        names = bucket_names(matrix(batch.column("vector")))
        flat = names.reshape(len(names), -1)
        at = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.ListArray.from_arrays(pa.array(at), pa.array(flat.reshape(-1)))], names=[*batch.schema.names, "names"]
        )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Whole groups, many at a time, of rows that arrive sorted by group."""
    held: list[dict] = []

    def joined() -> dict:
        return {k: np.concatenate([h[k] for h in held]) for k in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        own = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("place", "low", "high", "tile", "probe", "node", "copies")}
        own["vector"], own["names"] = matrix(batch.column("vector")), matrix(batch.column("names")).astype(np.int64)
        key = (own["place"], own["low"], own["high"])
        last = [k[-1] for k in key]
        open_from = int(np.flatnonzero(np.logical_and.reduce([k == v for k, v in zip(key, last, strict=True)]))[0])
        if open_from == 0 and held and all(h[n][-1] == v for h, n, v in [(held[-1], n, v) for n, v in zip(("place", "low", "high"), last, strict=True)]):
            held.append(own)
            continue
        held.append({k: v[:open_from] for k, v in own.items()})
        whole = joined()
        if len(whole["node"]):
            yield whole
        held = [{k: v[open_from:] for k, v in own.items()}]
    if held:
        yield joined()


def _links(threshold: float):
    """Degrees (other is NULL) and forest edges (links is 0) of the groups of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            change = np.ones(len(g["node"]), bool)
            change[1:] = (np.diff(g["place"]) != 0) | (np.diff(g["low"]) != 0) | (np.diff(g["high"]) != 0)
            starts = np.flatnonzero(change)
            ends = np.repeat(np.append(starts[1:], len(change)), np.diff(np.append(starts, len(change))))
            after = ends - np.arange(len(change)) - 1
            norms = np.linalg.norm(g["vector"], axis=1)
            names = g["names"].reshape(len(norms), TABLES, 1 + PROBES)
            found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            degree = np.zeros(len(norms), np.int64)
            for a, b in pair_runs(after, PAIRS_AT_ONCE):
                i = np.repeat(np.arange(a, b), after[a:b])
                j = ragged(np.arange(a, b) + 1, after[a:b])
                kept = ~((g["probe"][i] > 0) & (g["probe"][j] > 0)) & (g["node"][i] != g["node"][j])
                kept &= (g["low"][i] == g["high"][i]) | (g["tile"][i] != g["tile"][j])
                i, j = i[kept], j[kept]
                near = dots(g["vector"][i], g["vector"][j]) >= threshold * (norms[i] * norms[j])
                i, j = i[near], j[near]
                here = first_meeting(names[i], names[j]) == g["place"][i]
                i, j = i[here], j[here]
                np.add.at(degree, i, g["copies"][j])
                np.add.at(degree, j, g["copies"][i])
                more_a, more_b = spanning(g["node"][i], g["node"][j])
                found_a.append(more_a)
                found_b.append(more_b)
            own = np.flatnonzero(degree)
            a, b = spanning(np.concatenate(found_a), np.concatenate(found_b))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([g["node"][own], a])),
                    pa.array(np.concatenate([np.zeros(len(own), np.int64), b]), mask=np.arange(len(own) + len(a)) < len(own)),
                    pa.array(np.concatenate([degree[own], np.zeros(len(a), np.int64)])),
                ],
                names=["node", "other", "links"],
            )

    return run


def near_duplicates(df: DataFrame, threshold: float = 0.9, tile_rows: int = TILE_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = vectors(df).where("vec_id IS NOT NULL").withColumn("vector", F.when(usable("vector"), F.col("vector")))
    bounded_batches(df.sparkSession)
    # -0.0 and 0.0 are one number.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    classes = stored(
        rows.where("vector IS NOT NULL").groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")).mapInArrow(
            _hash, "vector array<double>, node long, copies long, names array<long>"
        ),
        "classes",
    )
    width = 1 + PROBES
    places = classes.select("node", "copies", "vector", "names", F.posexplode("names").alias("_at", "_bucket")).select(
        "node", "copies", "vector", "names",
        (F.shiftleft(F.floor(F.col("_at") / width).cast("long"), 48) + F.col("_bucket")).alias("place"),
        (F.col("_at") % width > 0).cast("int").alias("probe"),
    )
    sizes = places.groupBy("place").agg(F.count("*").alias("_n"), F.min("probe").alias("_own")).where("_n > 1 AND _own = 0")
    tiles = F.ceil(F.col("_n") / F.lit(tile_rows)).cast("int")
    dealt = (
        places.join(sizes.select("place", tiles.alias("_tiles")), "place")
        .withColumn("tile", F.when(F.col("_tiles") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("node"), "_tiles")).cast("int"))
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
        .select(
            "place", F.least("tile", "_with").alias("low"), F.greatest("tile", "_with").alias("high"),
            "tile", "probe", "node", "copies", "vector", "names",
        )
    )
    key = ("place", "low", "high")
    found = stored(dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_links(threshold), LINKS), "links")
    degrees = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("_links"))
    groups = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    by_class = (
        classes.select("node", "copies", "vector")
        .join(degrees, "node", "left")
        .join(groups, "node", "left")
        .select(
            F.col("vector").alias("_vector"),
            (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n"),
            F.coalesce("component", "node").alias("_component"),
        )
    )
    return rows.join(by_class, F.col("vector") == F.col("_vector"), "left").select(
        "vec_id",
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_component", "vec_id").alias("component_id"),
        (F.coalesce("_component", "vec_id") == F.col("vec_id")).alias("kept"),
    )


def op5_vector_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)
