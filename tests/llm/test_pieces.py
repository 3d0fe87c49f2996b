"""Encoding and decoding against the library."""

from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor

from ledgerloom.llm.common import tokenizer_path
from ledgerloom.llm.sentence_pieces import PieceEncoder, decode_pieces, encode_pieces

PATH = "piece_bpe_32k.model"
HARD = [
    None, "", " ", "   ", " a", "a ", "a  b", "\ta\n", "▁x", "a▁b", "é́", "ﬁ ½", "​ x", "a\x00b", "<s> </s> <unk> <0x41>", "漢字𝔘 漢", "aaaaaaaaaaaaaa aaaa",
    "    def f(x):\n        return  x", "a" * 3000, "lololololo ininininin", "Übergrößenträger naïve", " " * 100 + "z",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=tokenizer_path(PATH))


@pytest.fixture(scope="module")
def codec():
    return PieceEncoder(tokenizer_path(PATH))


def same(codec, library, texts):
    ids, at = codec.encode(texts)
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(text), text
    assert codec.decode(ids, at) == [library.decode(library.encode(t)) for t in texts]


def test_hard_texts(codec, library):
    same(codec, library, [t or "" for t in HARD])


def test_random_letters(codec, library):
    rng = random.Random(2)
    for letters in ("ab", "etaoin shr", "the and ing er 12.,'-", "éèüß漢𝔘 xyz"):
        same(codec, library, ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(400)])


def test_documents(codec, library):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    same(codec, library, texts[:300])


def test_random_ids_decode_as_in_the_library(codec, library):
    rng = np.random.default_rng(3)
    rows = [[300, *rng.integers(3, 259, 12).tolist()] for _ in range(50)] + [rng.integers(300, 32_000, 30).tolist() for _ in range(50)]
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    assert codec.decode(np.concatenate([np.array(r) for r in rows]), at) == [library.decode(r) for r in rows]


def test_table(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(HARD)] + [(None, "a b", "x"), (0, None, "x")], "doc_id long, text string, ids string")
    rows = decode_pieces(encode_pieces(docs.repartition(3), PATH), PATH).collect()
    assert len(rows) == len(HARD) + 2
    for r in rows:
        text = "a b" if r.doc_id is None else HARD[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<i4").tolist() == library.encode(text) and r.n_bytes == len(text.encode())
        assert r.text == library.decode(library.encode(text))
    both = {(r.doc_id, r.ids, r.text) for r in encode_pieces(docs, PATH, decode=True).collect()}
    assert both == {(r.doc_id, r.ids, r.text) for r in rows}
    assert encode_pieces(docs.limit(0), PATH).count() == 0
