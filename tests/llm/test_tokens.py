"""Token counts, packed id files and packing against the library and brute force."""

from __future__ import annotations

import bisect
import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.bit_files import bits_for, pack, read_ids, unpack, write_ids
from ledgerloom.llm.byte_ids import IdEncoder
from ledgerloom.llm.common import tokenizer_path
from ledgerloom.llm.packing import best_fit, cut_pieces, plan_bins
from ledgerloom.llm.token_counts import ChunkedCounter, token_counts
from ledgerloom.session import shared_folder

HARD = [
    None, "", " ", "  a  b\n\n c \t d  ", " x", "a<|endoftext|> b <|endoftext|>", "　 a \xa0 b\x1c c \x85 d",
    "it's 'll  we'll\r\n  y ", "\n", "é ö  ü 漢字 かな 😀", "tab\tb c\t d", "x, y. z), _. ½, ", "A" * 300 + " " + "9" * 50,
    "é ́a 가", "ü, ß. é", "<|startoftext|>" * 4,
]
LONG = " ".join(["Reader's 12 words, naïve été!", "<|endoftext|>", "longer" * 9, "\n\n"] * 120)
DOCS = [(i, t) for i, t in enumerate(HARD)] + [(100, LONG), (101, LONG), (102, "solid" * 900)]
SCHEMA = "doc_id long, text string"


def library(name: str) -> Tokenizer:
    return Tokenizer.from_file(tokenizer_path(name))


def test_cached_ids_equal_the_library():
    plain, encoder = library("byte_bpe_50k.json"), IdEncoder("byte_bpe_50k.json", limit=50)
    for _ in range(2):
        texts = [t or "" for _, t in DOCS]
        ids, at = encoder.encode(texts)
        for i, text in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize(("chunk", "overlap"), [(200, 40), (333, 100), (97, 96), (1000, 10)])
def test_chunks_equal_whole_texts(chunk, overlap):
    plain = library("word_bpe_49k.json")
    counter = ChunkedCounter("word_bpe_49k.json", chunk=chunk, overlap=overlap, margin=32)
    rng = random.Random(chunk)
    texts = [LONG, "solid" * 900, " " * 3000 + "x", "a " * 1500, "<|endoftext|>" * 200, "é" * 2500, "é" * 900]
    texts += ["".join(rng.choice(["a", "B", " ", "  ", "'s", "́", "7", "!!", "<|endoftext|>", "漢"]) for _ in range(1500)) for _ in range(8)]
    for text in texts:
        assert counter.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_token_counts_of_a_table(spark):
    plain = library("word_bpe_49k.json")
    docs = spark.createDataFrame([(*d, "x") for d in DOCS], SCHEMA + ", n_tokens string")
    rows = {r.doc_id: r for r in token_counts(docs, "word_bpe_49k.json", 100).collect()}
    assert len(rows) == len(DOCS)
    for doc_id, text in DOCS:
        n = len(plain.encode(text or "", add_special_tokens=False).ids)
        assert (rows[doc_id].n_tokens, rows[doc_id].n_bytes, rows[doc_id].over_limit) == (n, len((text or "").encode()), n > 100)
    assert token_counts(docs.limit(0), "word_bpe_49k.json", 100).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 24, 31])
def test_bits_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 4095, 4097):
        ids = rng.integers(0, 1 << bits, n).astype(np.uint32)
        data = pack(ids, bits)
        assert len(data) == -(-n * bits // 8)
        assert unpack(data, n, bits).tolist() == ids.tolist()
    assert bits_for(1 << bits) == bits


def test_files_hold_every_document_in_order(spark):
    plain = library("byte_bpe_50k.json")
    docs = [*DOCS, (5, "again"), (None, "no id"), (7, None)]
    folder = shared_folder(spark, "bits-test")
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    rows = read_ids(write_ids(frame, folder, "byte_bpe_50k.json"), folder, docs_per_task=3, with_ids=True).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted([d for d, _ in docs], key=lambda d: (d is not None, d or 0))
    place, left = 0, {}
    for d, t in docs:
        left.setdefault(d, []).append([*plain.encode(t or "", add_special_tokens=False).ids, 0])
    for r in rows:
        assert r.start == place and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        left[r.doc_id].remove(list(r.ids))
        place += r.n_tokens
    assert not any(left.values())
    assert read_ids(write_ids(frame.limit(0), folder + "-none", "byte_bpe_50k.json"), folder).count() == 0


def greedy(items: list[int], capacity: int) -> int:
    free, n = [], 0
    for size in sorted(items, reverse=True):
        i = bisect.bisect_left(free, size)
        n, left = (n + 1, capacity) if i == len(free) else (n, free.pop(i))
        bisect.insort(free, left - size)
    return n


def test_plan_equals_best_fit_decreasing_row_by_row():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.choice([7, 50, 1024])
        items = [rng.randint(1, max(1, capacity // rng.choice([1, 1, 5]))) for _ in range(rng.randint(0, 300))]
        _, n = plan_bins({s: items.count(s) for s in set(items)}, capacity)
        assert n == greedy(items, capacity)


def test_pieces_fill_sequences_without_gaps(spark):
    plain = library("byte_bpe_50k.json")
    frame = spark.createDataFrame(DOCS * 3, SCHEMA).repartition(4)
    rows = best_fit(cut_pieces(frame, "byte_bpe_50k.json", 64, 2), 64).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in DOCS:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert len(own) == 3 * -(-len(ids) // 64)
        for r in own:
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]
            assert r.length == 64 or r.piece == 0
    for own in by_sequence.values():
        place = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= 64
    assert len(by_sequence) == greedy([r.length for r in rows], 64)


def test_texts_are_encoded_by_one_worker_per_core(spark, tmp_path, monkeypatch):
    """Pieces are numbered in a stage of their own: workers of the other one share no core, nor its words."""
    spark.createDataFrame(DOCS * 2, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    plans = []

    def watched(rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return best_fit(rows, *args)

    monkeypatch.setattr(packing, "best_fit", watched)
    rows = packing.op1_best_fit_packing(spark, str(tmp_path)).collect()
    assert len(plans) == 1 and "Scan parquet" in plans[0] and "MapInArrow" not in plans[0]
    plain, found = library("byte_bpe_50k.json"), {}
    for r in rows:
        found.setdefault((r.doc_id, r.piece), []).append((r.start, r.length, r.ids_crc32))
    wanted = {}
    for doc_id, text in DOCS:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(itertools.pairwise(cuts)):
            wanted[doc_id, piece] = [(a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] * 2
    assert found == wanted
    assert len({r.sequence_id for r in rows}) == greedy([r.length for r in rows], 1024)


def test_lengths_outside_the_capacity_get_no_place(spark):
    frame = spark.createDataFrame([(1, None), (2, 0), (3, 9), (4, 8), (5, -1), (6, 8)], "id long, length int")
    rows = {r.id: (r.sequence_id, r.offset) for r in best_fit(frame, 8).collect()}
    assert sorted(i for i in rows if rows[i] == (None, None)) == [1, 2, 3, 5]
    assert {rows[4][0], rows[6][0]} == {0, 1}
    assert best_fit(frame.limit(0), 8).count() == 0
    with pytest.raises(ValueError, match="reserved"):
        best_fit(frame.withColumnRenamed("id", "offset"), 8)


def test_counts_by_parts_equal_the_library():
    plain, counter = library("word_bpe_49k.json"), ChunkedCounter("word_bpe_49k.json")
    texts = [t or "" for _, t in DOCS] + ["a ́b", "Å ᄀ ᅡ", "don't  DON'T x", "<|endof text|> <|endoftext|>x"]
    for _ in range(2):
        assert counter.counts(texts).tolist() == [len(plain.encode(t, add_special_tokens=False).ids) for t in texts]
