"""Benchmark windows in texts against a row by row version."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.llm.decontaminate import contamination, remove_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10):
    windows = {}
    for item_id, text in items:
        w = split(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(g) for g in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc_id, len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def rows(found):
    return sorted(((r.doc.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=repr)


LONG = " ".join(f"w{i}" for i in range(40))
DOCS = [
    (1, LONG.upper().replace(" ", ", ")), (2, "x " + LONG[: LONG.index("w25")] + " y " + LONG[LONG.index("w30") :]), (3, None), (4, ""), (5, "..."),
    (6, "say Über-Maß 7 again"), (6, "say Über-Maß 7 again"), (None, LONG), (8, "w0 w1 w2 w3 w4 w5 w6 w7 w8"), (9, "über maß 7"), (10, " ".join(["go"] * 3000)),
]
ITEMS = [(3, LONG), (20, LONG), (20, LONG), (4, "über MAß 7"), (4, "Über maß 7"), (None, "w30 w31"), (7, None), (8, ""), (9, " ".join(["go"] * 12))]


def test_equals_brute_force(spark):
    assert rows(contamination(*frames(spark, DOCS, ITEMS))) == brute(DOCS, ITEMS)


def test_parts_of_a_large_benchmark_find_the_same(spark):
    found = contamination(*frames(spark, DOCS, ITEMS), broadcast_bytes=2500)
    assert rows(found) == brute(DOCS, ITEMS)


def test_empty_tables(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert contamination(docs.limit(0), items).count() == 0
    assert rows(contamination(docs, items.limit(0))) == brute(DOCS, [])


def test_clashing_columns_and_modes(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    names = ("row", "words", "at", "window", "doc", "n", "key", "gram")
    wide = docs.selectExpr("doc_id", "text", *[f"doc_id AS `{n}`" for n in names])
    clean = remove_contaminated(wide, items)
    assert clean.columns == wide.columns
    want = {d for d, _, hit, _ in brute(DOCS, ITEMS) if not hit}
    assert {r.doc_id for r in clean.collect()} == want
    cut = {r.doc_id: r.text for r in remove_contaminated(wide, items, "spans").collect()}
    assert cut[2] == "x   y " and cut[1] == "" and cut[3] is None and cut[5] == "..." and cut[8] == DOCS[8][1]
    assert cut[6] == "say  again" and cut[9] == ""
    with pytest.raises(ValueError, match="unknown mode"):
        remove_contaminated(docs, items, "words")


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.lists(st.sampled_from(["a", "B", "c", "é", "-", "1"]), max_size=25), min_size=1, max_size=8),
    st.lists(st.lists(st.sampled_from(["a", "b", "c", "é", "1"]), max_size=7), min_size=1, max_size=4),
    st.sampled_from([1, 3, 4]),
)
def test_random_words(spark, texts, items, size):
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    known = [(i, " ".join(t)) for i, t in enumerate(items)]
    assert rows(contamination(*frames(spark, docs, known), size=size)) == brute(docs, known, size)
