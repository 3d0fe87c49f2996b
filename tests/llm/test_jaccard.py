"""The similarity join against brute force on sets of tuples."""

from __future__ import annotations

import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import jaccard_join, shingles
from ledgerloom.llm.common import text_bytes
from ledgerloom.llm.jaccard_join import similar_texts
from ledgerloom.llm.shingles import overlap, shingle_sets

EDGE = [None, "", "  \n", "a b", "A  B\t", "b a", "one two three four", "é É x y z w", "one two three four five", "ONE two\x0bthree four five", "x" * 5000, "word " * 400]


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute(docs: list[tuple]) -> dict:
    sets = [(d, brute_set(t)) for d, t in docs if d is not None]
    label = {d: d for d, _ in sets}
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return {d: (len(s), label[d]) for d, s in sets}


def corpus(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnopq") + rng.choice("rstuvw") + rng.choice(["", "xy", "z"])
    passage = " ".join(word() for _ in range(30))
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.45:
            words = rng.choice(texts[-40:]).split()
            for _ in range(rng.randint(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
        else:
            own = " ".join(word() for _ in range(rng.randint(3, 120)))
            texts.append(f"{passage} {own}" if kind < 0.65 else own)
    return list(enumerate(texts))


def test_sets_equal_brute_force(monkeypatch):
    texts = EDGE + [t for _, t in corpus(60, 3)] + ["a b c d e f a b c d e f"]
    want = [brute_set(t) for t in texts]
    whole = shingle_sets(*text_bytes(pa.array(texts)))
    monkeypatch.setattr(shingles, "PIECE_BYTES", 64)
    for sets in (whole, shingle_sets(*text_bytes(pa.array(texts)))):
        assert [len(s) for s in sets] == [len(s) for s in want]
        for i in range(0, len(texts), 3):
            assert [overlap(sets[i], s) for s in sets] == [len(want[i] & s) for s in want]


@pytest.mark.parametrize(("crowd", "leaf"), [(64, 256), (3, 8)])
def test_components_equal_brute_force(spark, monkeypatch, crowd, leaf):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    monkeypatch.setattr(jaccard_join, "LEAF_ROWS", leaf)
    docs = corpus(320, crowd)
    docs += [(1000 + i, t) for i, t in enumerate(EDGE)] + [(2000, docs[7][1]), (2000, docs[7][1]), (None, docs[7][1]), (-5, docs[9][1].upper())]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, p string, n int").repartition(4)
    rows = similar_texts(frame).collect()
    assert len(rows) == len(docs)
    want = brute(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == want
    assert [r.component_id for r in rows if r.doc_id is None] == [None]


def test_empty_table(spark):
    assert similar_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def unrelated(n: int, words: int = 12) -> list[tuple]:
    return [(i, " ".join(f"{i}w{k}" for k in range(words))) for i in range(n)]


@pytest.mark.parametrize("docs", [unrelated(1), unrelated(5), [*unrelated(5), (9, unrelated(5)[2][1] + " more")]])
@pytest.mark.parametrize("partitions", [8, 200])
def test_buckets_without_pairs(spark, docs, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = similar_texts(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs)


def test_buckets_of_crowds_only(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CROWD", 3)
    base = " ".join(f"w{k}" for k in range(40))
    docs = [(i, f"{base} tail{i}") for i in range(12)]
    rows = similar_texts(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    rule = jaccard_join.Threshold(Fraction(3, 4))
    for n in (1, 4, 5, 63, 64, 65, 700):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        other = np.unique(np.concatenate([base[: int(n * 0.9)], rng.integers(0, 2**63, n // 10).astype(np.uint64)]))
        a, b = jaccard_join.point(base), jaccard_join.point(other)
        groups = min(len(a), len(b))
        assert np.minimum(jaccard_join.folded(a, groups), jaccard_join.folded(b, groups)).sum() >= overlap(base, other)
        assert (jaccard_join.point_from(jaccard_join.point_bytes(a), len(base)) == a).all()
        assert rule.prefix(n) == n - int(np.ceil(0.75 * n)) + 1
