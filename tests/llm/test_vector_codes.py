"""Codebooks and codes against a version row by row, and the block bounds on their own."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from ledgerloom.llm import vector_codes
from ledgerloom.llm.hilbert import hilbert_order
from ledgerloom.llm.vector_codes import Blocks, VectorCodes, with_group_sum


def brute(rows, parts=8, entries=16, rounds=6):
    """(codes and errors by row, digest) in plain integers."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    d = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == d]
    ints = [[math.floor(4096 * x) for x in v] for _, v, _ in kept]
    cuts = [(p * d // parts, (p + 1) * d // parts) for p in range(parts)]
    books = [[row[a:b] for row in ints[:entries]] for a, b in cuts]

    def nearest(piece, book):
        return min((sum((x - y) ** 2 for x, y in zip(piece, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            groups = defaultdict(list)
            for row in ints:
                groups[nearest(row[a:b], books[p])[1]].append(row[a:b])
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)] if e in groups else entry for e, entry in enumerate(books[p])]
    out = []
    for (i, _, lab), row in zip(kept, ints, strict=True):
        near = [nearest(row[a:b], books[p]) for p, (a, b) in enumerate(cuts)]
        out.append((i, "".join(f"{e:02x}" for _, e in near), sum(f for f, _ in near), lab))
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(out, key=repr), digest


def vectors(n, d, seed, spread=0.05):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, d))
    return [(int(i), [float(x) for x in centres[i % 5] + spread * r.normal(size=d)], int(i % 3) if i % 7 else None) for i in r.permutation(n)]


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def as_float(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]


def coded(model):
    return sorted(((r.vec_id, r.code, r.error, r.label) for r in model.codes().collect()), key=repr)


@pytest.mark.parametrize(("n", "d", "seed"), [(300, 16, 1), (40, 64, 2), (9, 24, 3), (120, 13, 4)])
def test_equals_brute_force(spark, n, d, seed):
    rows = vectors(n, d, seed)
    model = VectorCodes(frame(spark, rows).repartition(3))
    assert (coded(model), model.digest()) == brute(as_float(rows))


def test_odd_rows(spark):
    rows = vectors(60, 16, 5)
    rows += [(100, None, 1), (101, [float("nan")] * 16, 1), (102, [float("inf")] * 16, 1), (103, [None] * 16, 2), (104, [0.5] * 15, 1), (None, [0.25] * 16, 1)]
    rows += [rows[0], rows[0], (rows[1][0], [0.125] * 16, None), (2, [-0.0001] * 16, 2)]
    model = VectorCodes(frame(spark, rows).selectExpr("*", "vec_id AS code", "label AS vector", "1 AS ids"))
    assert (coded(model), model.digest()) == brute(as_float(rows))


def test_equal_vectors_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "CHUNK_ROWS", 7)
    rows = [(i, [1.0, 2.0, -1.0, 0.5] * 2, 1) for i in range(50)] + vectors(40, 8, 6)[:30]
    model = VectorCodes(frame(spark, rows))
    assert model.chunks.count() >= len(rows) // 7
    assert (coded(model), model.digest()) == brute(as_float(rows))


def test_empty_tables_and_empty_vectors(spark):
    model = VectorCodes(frame(spark, vectors(5, 8, 1)).limit(0))
    assert coded(model) == [] and model.digest() == hashlib.sha256(b"").hexdigest()
    model = VectorCodes(frame(spark, [(1, [], 2), (2, [], None)]))
    assert coded(model) == [(1, "00" * 8, 0, 2), (2, "00" * 8, 0, None)]


def test_too_large_components_are_an_error(spark):
    with pytest.raises(ValueError, match="cannot be coded"):
        VectorCodes(frame(spark, [(1, [1e30] * 8, 1)]))


def test_shortlists_hold_the_nearest_and_are_short():
    r = np.random.default_rng(8)
    pieces = np.concatenate([c + r.integers(-200, 200, (800, 8)) for c in r.integers(-20_000, 20_000, (16, 8))])
    book = pieces[:: len(pieces) // 16][:16]
    blocks = Blocks.build(pieces)
    listed = blocks.shortlists(book)
    entry, error = blocks.codes(book)
    far = ((pieces[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (entry == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()
    assert listed.mean() < 0.3


def test_hilbert_order_visits_neighbours():
    side = 16
    grid = np.array([(x, y) for x in range(side) for y in range(side)])
    path = grid[hilbert_order(grid)]
    assert len({tuple(p) for p in path.tolist()}) == side * side
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_group_sums_for_common_and_rare_groups(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "COMMON", 4)
    rows = [(i, None if i % 5 == 0 else (1 if i % 2 else i), i) for i in range(200)]
    got = {(r.k, r.g): r.s for r in with_group_sum(spark.createDataFrame(rows, "k int, g int, v long"), "g", "v", "s").collect()}
    want = defaultdict(int)
    for _, g, v in rows:
        want[g] += v
    assert got == {(k, g): want[g] for k, g, _ in rows}
