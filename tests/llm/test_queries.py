"""The registered queries over whole tables, against brute force, the libraries or SQL."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from ledgerloom.llm.common import tokenizer_path
from tests.llm.test_jaccard import brute as similar
from tests.llm.test_suffix import brute as repeats
from tests.llm.test_vectors import brute_links

DIR = "/root/testdata/sf0.001"
PREFIXES = [f"op{n}_" for n in range(1, 14)]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def docs():
    table = pq.read_table(f"{DIR}/documents.parquet").to_pydict()
    return list(zip(table["doc_id"], table["text"], strict=True))


@pytest.fixture(scope="module")
def vectors():
    table = pq.read_table(f"{DIR}/embeddings.parquet").to_pydict()
    return dict(zip(table["vec_id"], table["embedding"], strict=True))


def rows(spark, prefix: str) -> list:
    (name,) = [n for n in queries() if n.startswith(prefix)]
    return queries()[name](spark, DIR).collect()


def test_all_are_registered():
    for prefix in PREFIXES:
        assert sum(n.startswith(prefix) for n in queries()) == 1
    assert "pipeline" in queries()


def test_op1(spark, docs):
    plain = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    found = rows(spark, "op1_")
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in docs:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        for r in by_doc[doc_id]:
            assert r.ids_crc32 == crc(ids[r.start : r.start + r.length])
        assert sorted((r.piece, r.start) for r in by_doc[doc_id])[0] == (0, 0)
        assert sum(r.length for r in by_doc[doc_id]) == len(ids)
    assert len({r.sequence_id for r in found}) <= 1.01 * sum(r.length for r in found) / 1024 + 1


def test_op2(spark, docs):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, "op2_")} == similar(docs)


def test_op3(spark, docs):
    plain = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {d: len(plain.encode(t, add_special_tokens=False).ids) for d, t in docs}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows(spark, "op3_")} == {
        d: (len(t.encode()), want[d], want[d] > 2048) for d, t in docs
    }


def test_op4(spark, docs):
    found = rows(spark, "op4_")
    assert {r.doc_id: r.held_out for r in found} == {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _ in docs}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_op5(spark, vectors):
    found = {r.vec_id: (r.n_links, r.component_id) for r in rows(spark, "op5_")}
    want = brute_links(vectors, 0.9)
    assert sum(n for n, _ in found.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert found.keys() == want.keys() and all(found[v][0] <= want[v][0] for v in want)


def test_op6(spark, docs):
    library = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for r in rows(spark, "op6_"):
        ids = library.encode(dict(docs)[r.doc_id])
        assert (r.n_tokens, r.ids_crc32) == (len(ids), crc(ids))
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_op7(spark, vectors):
    ids = np.array(sorted(vectors))
    m = np.array([vectors[i] for i in ids], np.float64)
    found = {}
    for r in rows(spark, "op7_"):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(found) == [i for i in ids.tolist() if i % 20 == 0]
    for q, hits in found.items():
        scores = m @ m[np.searchsorted(ids, q)]
        best = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        assert np.allclose([s for _, _, s in sorted(hits)], scores[best], rtol=1e-12, atol=1e-15)
        assert len(hits) == min(20, len(ids) - 1)


def test_op8(spark, docs):
    plain = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    place, texts = 0, dict(docs)
    for r in sorted(rows(spark, "op8_"), key=lambda r: r.doc_id):
        ids = [*plain.encode(texts[r.doc_id], add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (place, len(ids), crc(ids))
        place += len(ids)


def test_op9(spark, docs):
    want = repeats(docs)
    found = rows(spark, "op9_")
    assert len(found) == len(docs)
    for r in found:
        ((n, spans, kept),) = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, n - len(kept), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize(("prefix", "tables"), [("op10_", ["pages"]), ("op11_", ["documents"]), ("op12_", ["embeddings"]), ("op13_", ["documents", "benchmark"])])
def test_equals_sql(spark, prefix, tables):
    db = duckdb.connect()
    for name in tables:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    (query,) = [n for n in queries() if n.startswith(prefix)]
    cursor = db.execute(oracle_sql()[query])
    names = [c[0] for c in cursor.description]
    found = rows(spark, prefix)
    assert found and sorted(found[0].asDict()) == sorted(names)
    want = sorted((tuple(sorted(dict(zip(names, row, strict=True)).items())) for row in cursor.fetchall()), key=repr)
    assert sorted((tuple(sorted(r.asDict().items())) for r in found), key=repr) == want
