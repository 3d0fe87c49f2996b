"""Neighbours and near-duplicates of vectors against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import vector_dedup
from ledgerloom.llm.neighbours import nearest, quantise

SCHEMA = "vec_id long, embedding array<float>, rank string, label int"
NAN, INF = float("nan"), float("inf")


def rows_of(n: int, d: int = 16, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)).astype(np.float32)
    base[n // 2 : n // 2 + n // 8] = base[0]
    rows = [(i, v.tolist(), "x", None) for i, v in enumerate(base)]
    bad = [None, [], [0.0] * d, [NAN] + [1.0] * (d - 1), [INF] + [1.0] * (d - 1), [None] + [1.0] * (d - 1)]
    return rows + [(n + 20 * i, v, "x", None) for i, v in enumerate(bad)] + [(None, base[1].tolist(), "x", None), rows[3]]


def test_neighbours_equal_brute_force(spark):
    n = 300
    rows = rows_of(n)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in nearest(frame, F.col("vec_id") % 20 == 0, 20, block_rows=64).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = np.array([r[1] for r in rows[:n]], np.float64)
    assert sorted(got) == list(range(0, n, 20))
    for q, found in got.items():
        scores = np.einsum("ij,j->i", good, good[q])
        order = sorted((i for i in range(n) if i != q), key=lambda i: (-scores[i], i))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert np.allclose([f[2] for f in found], scores[order], rtol=1e-12)
        assert [f[1] for f in found] == order


def test_few_or_no_candidates(spark):
    frame = spark.createDataFrame(rows_of(8)[:3], SCHEMA)
    assert sorted((r.query_id, r.vec_id) for r in nearest(frame, F.col("vec_id") >= 0, 20).collect()) == [
        (a, b) for a in range(3) for b in range(3) if a != b
    ]
    assert nearest(frame.limit(0), F.col("vec_id") >= 0, 20).count() == 0
    assert nearest(frame, F.col("vec_id") < 0, 20).count() == 0


def test_a_group_of_one_row_has_no_pairs():
    names = np.zeros((1, vector_dedup.TABLES * (1 + vector_dedup.PROBES)), np.int64)
    one = {k: pa.array([0], pa.int64()) for k in ("place", "low", "high", "tile", "probe", "node")}
    batch = pa.RecordBatch.from_pydict({**one, "copies": pa.array([1]), "vector": pa.array([[1.0, 2.0]]), "names": pa.array(names.tolist())})
    assert sum(b.num_rows for b in vector_dedup._links(0.9)(iter([batch]))) == 0


def test_rounding_errors_are_bounds():
    rows = np.random.default_rng(0).normal(size=(50, 33))
    codes, scales, errors = quantise(rows)
    assert np.all(np.linalg.norm(rows - codes * scales[:, None], axis=1) <= errors + 1e-12)


def brute_links(vectors: dict, threshold: float):
    ids = sorted(vectors)
    m = np.array([vectors[i] for i in ids], np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    linked = m @ m.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.arange(len(ids))
    while True:
        best = np.where(linked, label[None, :], len(ids)).min(axis=1)
        new = np.minimum(label, best)
        if (new == label).all():
            return {v: (int(linked[i].sum()), ids[label[i]]) for i, v in enumerate(ids)}
        label = new


def clusters(n: int, d: int, seed: int) -> dict:
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 10, d))
    rows = centre[rng.integers(0, len(centre), n)] + 0.12 * rng.normal(size=(n, d))
    rows[5:40] = rows[5]
    return {i: v.astype(np.float32).tolist() for i, v in enumerate(rows)}


def test_vector_links_equal_brute_force(spark):
    from ledgerloom.llm.vector_dedup import near_duplicates

    vectors = clusters(600, 32, 3)
    bad = [(1000 + i, v, "x", None) for i, v in enumerate([None, [], [0.0] * 32, [NAN] * 32, [INF] + [1.0] * 31])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors.items()] + bad, SCHEMA).repartition(4)
    want = brute_links(vectors, 0.9)
    for tile_rows in (2048, 16):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(frame, 0.9, tile_rows).collect()}
        assert len(got) == 605
        assert all(got[i] == (0, i, True) for i in range(1000, 1005))
        assert all(got[i][0] <= n and got[i][2] == (got[i][1] == i) for i, (n, _) in want.items())
        assert sum(got[i][0] for i in want) >= 0.98 * sum(n for n, _ in want.values())
        assert sum(got[i][1] == c for i, (_, c) in want.items()) >= 0.98 * len(want)
    assert near_duplicates(frame.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    from ledgerloom.llm.components import components

    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7), (5000, 4000), (4000, 4500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(60)}, 5000: 4000, 4000: 4000, 4500: 4000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
