"""Scored phrases against counting in plain Python, and the automata on their own."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from ledgerloom.llm import phrases, transducer

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, longest=5, least=100, inside=100, top=2000):
    n, f = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    candidates = {c: a for c, a in f.items() if len(c) > 2 and a >= least}
    out = defaultdict(list)
    for (lang, *w), a in candidates.items():
        cuts = [(1000 * a * n[lang] // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        around = [
            b for (other, *v), b in candidates.items()
            if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
        ]
        if not any(100 * b >= inside * a for b in around):
            out[lang].append((" ".join(w), a, f[lang, *w[:k]], f[lang, *w[k:]], n[lang], score))
    rows = []
    for lang, own in out.items():
        own.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        rows += [(lang, i + 1, *r) for i, r in enumerate(own[:top])]
    return sorted(rows)


def found(spark, docs, **options):
    df = spark.createDataFrame(docs, "lang string, text string")
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def corpus(seed, n=150, words=12):
    r = np.random.default_rng(seed)
    names = ["The", "of", "ÉTÉ", "a", "b-c", "x", "ñ", "state", "union", "go", " ", "9"][:words]
    ends = [" ", " ", "  ", "\t", ". ", ", ", "\n", "?"]
    docs = []
    for _ in range(n):
        text = "".join(names[int(r.zipf(1.6)) % words] + ends[int(r.integers(len(ends)))] for _ in range(int(r.integers(0, 60))))
        docs.append(([None, "en", "fr", "und", ""][int(r.integers(5))], text + ("United States of America " if r.random() < 0.3 else "")))
    return docs + docs[:40]


def test_equals_brute_force(spark):
    docs = [*corpus(1), ("en", None), (None, ""), ("en", " ... ")]
    want = brute(docs, least=8)
    assert want and found(spark, docs, least=8) == want


def test_many_small_ranges_and_shards(spark, monkeypatch):
    for name, value in (("SHARD_BYTES", 300), ("RANGE_BYTES", 1500), ("SAMPLE_BYTES", 1 << 20), ("UNITE_PATHS", 50), ("LOOKUP_ROWS", 5), ("FEW_LANGS", 1)):
        monkeypatch.setattr(phrases, name, value)
    docs = corpus(2) + [("en", " the of" * 900), ("fr", "a, b-c. x; " * 300)]
    rows = spark.createDataFrame(docs, "lang string, text string")
    assert len(phrases._boundaries(rows.where("text IS NOT NULL AND lang IS NOT NULL"), 5)) > 5
    assert found(spark, docs, least=6, top=7) == brute(docs, least=6, top=7)


def test_other_bounds(spark):
    docs = corpus(3, words=6)
    assert found(spark, docs, longest=3, least=5, inside=60) == brute(docs, 3, 5, 60)


def test_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame(corpus(4), "lang string, text string").selectExpr("*", "1 AS phrase", "2 AS f", "3 AS n", "4 AS rank")
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df, least=10).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@given(st.lists(st.lists(st.integers(1, 6), min_size=1, max_size=4), min_size=1, max_size=40))
def test_an_automaton_is_read_as_written_and_adds_up(paths):
    padded = np.array([p + [0] * (4 - len(p)) for p in paths], np.int64)
    words = pa.array([bytes([96 + i]) for i in range(1, 7)], pa.binary())
    own, counts = transducer.summed(padded, np.ones(len(padded), np.int64), 6)
    names, again, same = transducer.read(transducer.written(words, own, counts))
    spell = lambda names, rows, c: {tuple(names[i - 1] for i in r if i): n for r, n in zip(rows.tolist(), c.tolist(), strict=True)}
    want = Counter(tuple(words[i - 1].as_py() for i in p) for p in paths)
    assert spell(names, again, same) == want
    both = transducer.union([(names, again, same), (names[:], again, 2 * same)])
    assert spell(both[0].to_pylist(), both[1], both[2]) == {p: 3 * n for p, n in want.items()}
    for k in range(1, 5):
        states, weight, _ = transducer.states(own, counts, k)
        prefixes = Counter(tuple(p[:k]) for p in paths if len(p) >= k)
        assert {tuple(r): n for r, n in zip(states.tolist(), weight.tolist(), strict=True)} == prefixes
    walk = transducer.Lookup(own, counts, 6)
    asked = np.array([p + [0] * (4 - len(p)) for p in [*paths, [1, 1, 1, 1], [6], [-1, 2]]])
    assert walk.walk(asked).tolist() == [Counter(map(tuple, paths))[tuple(x for x in row if x)] for row in asked.tolist()]
