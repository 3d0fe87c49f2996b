"""SentencePiece encoding and decoding by suffix-array matching.

Texts are cut into units, each a run of word marks and what follows: no piece
of the vocabulary has a mark after another character, so units are encoded on
their own, and each distinct one once. The new units of a batch are
concatenated and indexed by a suffix array. Every piece of the vocabulary is
looked up by binary search, which gives all its occurrences as edges from one
place to another. Edges are sorted by position and relaxed in that order.

The vocabulary is a merge vocabulary, so the wanted path is not the one of the
best total score but the one the merges give. For those a known property
replaces the score: a sequence of pieces is the merged one exactly if every
two neighbours, merged on their own, come out as they are. A prefix has one
such path, so each place keeps the one edge that fits the edge before it.
Whether two pieces fit is found out by merging them once and is remembered.
Units with runs of marks (equal scores tie there), and any unit where the
relaxation does not leave one path, are merged directly instead.

Cases: NULL and empty texts have no ids and decode to an empty text. Characters
outside the vocabulary become byte pieces. The mark character itself decodes to
a space, as in the library. Repeated rows are encoded each; other columns are
not read; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import KEPT, bounded_batches, one_thread, ragged, slices, table, tidy, tokenizer_path
from ledgerloom.llm.suffix_blocks import refine, word_view
from ledgerloom.llm.unit_cache import UnitCache

MARK = "▁"
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")
BATCH_BYTES = 2 << 20
#: Distinct units and pairs that a worker keeps; beyond it pairs start again.
KEPT_UNITS, MAX_PAIRS = 300_000, 400_000
SEPARATOR = b"\xff"


class Vocabulary:
    """Pieces of a SentencePiece model of the merge kind with byte pieces."""

    def __init__(self, path: str) -> None:
        one_thread()
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = {model.id_to_piece(i): i for i in plain}
        self.scores = {p: model.get_score(i) for p, i in self.pieces.items()}
        self.bytes_to_id = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(n) if model.is_byte(i)}
        if len(self.bytes_to_id) != 256:
            raise ValueError("a vocabulary with byte pieces is needed")
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece goes on after a word mark inside it; texts cannot be cut there")
        self.n = n
        self.text = {i: p for p, i in self.pieces.items()}
        shown = [b""] * n
        for p, i in self.pieces.items():
            shown[i] = p.replace(MARK, " ").encode()
        for b, i in self.bytes_to_id.items():
            shown[i] = bytes([b])
        shown[model.unk_id()] = " ⁇ ".encode()
        self.lengths = np.array([len(s) for s in shown], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.shown = np.frombuffer(b"".join(shown), np.uint8)

    def merge(self, unit: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until none is a piece."""
        parts: list[str | None] = list(unit)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        score = self.scores.get
        queue = [(-s, i, parts[i] + parts[i + 1]) for i in range(len(parts) - 1) if (s := score(parts[i] + parts[i + 1])) is not None]
        heapify(queue)
        while queue:
            _, i, piece = heappop(queue)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != piece:
                continue
            parts[i], parts[j] = piece, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(parts) and (s := score(parts[a] + parts[b])) is not None:
                    heappush(queue, (-s, a, parts[a] + parts[b]))
        return [p for p in parts if p is not None]

    def ids(self, parts: list[str]) -> list[int]:
        """Ids of merged parts; a character that is no piece gives its bytes."""
        return [i for p in parts for i in ([self.pieces[p]] if p in self.pieces else [self.bytes_to_id[b] for b in p.encode()])]


class PieceEncoder:
    """Encodes batches of texts with one vocabulary."""

    def __init__(self, path: str) -> None:
        self.vocabulary = v = Vocabulary(path)
        # A piece that its own merges do not give can never be in a result.
        own = [(p.encode(), i) for p, i in v.pieces.items() if v.merge(p) == [p]]
        self.piece_ids = np.array([i for _, i in own], np.int64)
        self.piece_lengths = np.array([len(p) for p, _ in own], np.int64)
        self.longest = int(self.piece_lengths.max())
        words = np.array([[int.from_bytes(p[k : k + 8].ljust(8, fill), "big") for k in range(0, self.longest, 8)] for fill in (b"\0", b"\xff") for p, _ in own], np.uint64)
        self.low, self.high = words[: len(own)], words[len(own) :]
        self.units = UnitCache(self._fresh_ids, KEPT_UNITS)
        self.fits: dict[int, bool] = {}

    def _edges(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and id of every occurrence of a piece."""
        words = word_view(data)
        order, _ = refine(words, np.arange(len(data)), -(-self.longest // 8))
        first = words[order].astype(np.uint64)
        low = np.searchsorted(first, self.low[:, 0])
        count = np.searchsorted(first, self.high[:, 0], side="right") - low
        piece = np.repeat(np.arange(len(low)), count)
        start = order[ragged(low, count)]
        # Pieces longer than a word: compare the words that follow.
        for k in range(1, self.low.shape[1]):
            longer = np.flatnonzero(self.piece_lengths[piece] > 8 * k)
            if not len(longer):
                break
            word = words[start[longer] + 8 * k].astype(np.uint64)
            own = piece[longer]
            keep = np.ones(len(piece), bool)
            keep[longer] = (word >= self.low[own, k]) & (word <= self.high[own, k])
            piece, start = piece[keep], start[keep]
        return start, start + self.piece_lengths[piece], self.piece_ids[piece]

    def _name(self, token: int) -> str:
        return self.vocabulary.text[token] if token < self.vocabulary.n else chr(token - self.vocabulary.n)

    def _fit(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether pairs of tokens, merged on their own, stay as they are."""
        keys = (before * (1 << 22) + after).tolist()
        found = list(map(self.fits.get, keys))
        for i, known in enumerate(found):
            if known is None:
                key = keys[i]
                if key not in self.fits:
                    pair = [self._name(int(before[i])), self._name(int(after[i]))]
                    self.fits[key] = self.vocabulary.merge("".join(pair)) == pair
                found[i] = self.fits[key]
        return np.array(found, bool)

    def _relax(self, units: list[str]) -> list[list[int]]:
        """Ids of units by their edges."""
        v = self.vocabulary
        if len(self.fits) > MAX_PAIRS:
            self.fits.clear()
        raw = [u.encode() for u in units]
        data = SEPARATOR.join(raw) + SEPARATOR
        sizes = np.array([len(r) for r in raw], np.int64)
        begin = np.cumsum(sizes + 1) - sizes - 1
        start, end, token = self._edges(data)
        # Characters that are no piece are edges too.
        strange = [(begin[i] + len(u[:k].encode()), len(c.encode()), v.n + ord(c)) for i, u in enumerate(units) if not self.all_known(u) for k, c in enumerate(u) if c not in v.pieces]
        if strange:
            at, width, name = (np.array(c, np.int64) for c in zip(*strange, strict=True))
            start, end, token = np.concatenate([start, at]), np.concatenate([end, at + width]), np.concatenate([token, name])
        origin = np.repeat(begin, sizes + 1)
        place = end - origin[start]
        order = np.argsort(place, kind="stable")
        start, end, token, place = start[order], end[order], token[order], place[order]
        none = -2
        last, back = np.full(len(data) + 1, none, np.int64), np.zeros(len(data) + 1, np.int64)
        last[begin] = -1
        many = np.zeros(len(data) + 1, np.int32)
        cuts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(place)], strict=True):
            before = last[start[a:b]]
            fit = before == -1
            ask = np.flatnonzero(before >= 0)
            if len(ask):
                fit[ask] = self._fit(before[ask], token[a:b][ask])
            to = end[a:b][fit]
            last[to], back[to] = token[a:b][fit], start[a:b][fit]
            np.add.at(many, to, 1)
        # Walk back from the ends of all units at once.
        at = begin + sizes
        broken = np.zeros(len(units), bool)
        steps = []
        active = np.arange(len(units))
        while len(active):
            here = at[active]
            broken[active[(many[here] != 1)]] = True
            active = active[~broken[active]]
            here = at[active]
            steps.append((active, last[here]))
            at[active] = back[here]
            active = active[at[active] > begin[active]]
        found: list[list[int]] = [[] for _ in units]
        for active, tokens in reversed(steps):
            for i, t in zip(active.tolist(), tokens.tolist(), strict=True):
                if t < v.n:
                    found[i].append(t)
                else:
                    found[i] += [v.bytes_to_id[b] for b in chr(t - v.n).encode()]
        for i in np.flatnonzero(broken).tolist():
            found[i] = v.ids(v.merge(units[i]))
        return found

    def all_known(self, unit: str) -> bool:
        return all(map(self.vocabulary.pieces.__contains__, unit))

    def _fresh_ids(self, fresh: list[str]) -> list[list[int]]:
        v = self.vocabulary
        units = [u if u[:1] == MARK else MARK + u for u in fresh]
        runs = [i for i, u in enumerate(units) if u[1:2] == MARK or len(u) == 1]
        special = set(runs)
        found: list = [None] * len(units)
        for i in runs:
            found[i] = v.ids(v.merge(units[i]))
        rest = [i for i in range(len(units)) if i not in special]
        for i, ids in zip(rest, self._relax([units[i] for i in rest]) if rest else [], strict=True):
            found[i] = ids
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the n + 1 places where texts start."""
        parts: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                own = text.split(" ")
                if "" in own or MARK in text:
                    own = _UNIT.findall(MARK + text.replace(" ", MARK))
                parts += own
            ends[i + 1] = len(parts)
        ids, lengths = self.units.numbers(parts)
        return ids, np.concatenate([[0], np.cumsum(lengths)])[ends]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """Texts of rows of ids."""
        v = self.vocabulary
        lengths = v.lengths[ids]
        data = v.shown[ragged(v.starts[ids], lengths)].tobytes()
        cuts = np.concatenate([[0], np.cumsum(lengths)])[at].tolist()
        return [as_text(data[a + (data[a : a + 1] == b" " and a < b) : b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def as_text(data: bytes) -> str:
    """UTF-8 text; each byte that is part of no character becomes the replacement character."""
    try:
        return data.decode()
    except UnicodeDecodeError as error:
        return data[: error.start].decode() + "�" + as_text(data[error.start + 1 :])


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> PieceEncoder:
    """The encoder of this worker process; tasks that follow find its units."""
    own = PieceEncoder(path)
    KEPT.append(own.units.clear)
    return own


def encode_pieces(docs: DataFrame, vocabulary: str, decode: bool = False) -> DataFrame:
    """doc_id, n_bytes and ids (little-endian 32-bit) of whole texts.

    With ``decode`` the text that the ids decode to follows, from the same task:
    a pass of its own would keep a second worker with its cache per core.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_encoder(tokenizer_path(vocabulary))
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices([len(t) for t in texts], BATCH_BYTES):
                ids, at = codec.encode(texts[a:b])
                cuts = (at * 4).astype(np.int32)
                columns = [
                    batch.column("doc_id").slice(a, b - a),
                    batch.column("n_bytes").slice(a, b - a),
                    pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(cuts), pa.py_buffer(ids.astype("<i4"))]),
                ]
                if decode:
                    columns.append(pa.array(codec.decode(ids, at), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "ids", "text"][: len(columns)])

    bounded_batches(docs.sparkSession)
    sized = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return sized.mapInArrow(tidy(run, keeps=True), "doc_id long, n_bytes long, ids binary" + ", text string" * decode)


def decode_pieces(rows: DataFrame, vocabulary: str) -> DataFrame:
    """``rows`` of :func:`encode_pieces` with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_encoder(tokenizer_path(vocabulary))
        for batch in batches:
            column = batch.column("ids").fill_null(b"")
            sizes = [len(v.as_buffer()) for v in column]
            for a, b in slices(sizes, BATCH_BYTES):
                own = column.slice(a, b - a)
                ids = np.concatenate([np.frombuffer(v.as_buffer(), "<i4") for v in own])
                at = np.concatenate([[0], np.cumsum(sizes[a:b])]) // 4
                texts = pa.array(codec.decode(ids, at), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, texts], names=[*batch.schema.names, "text"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, ids binary, text string")


def op6_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), "piece_bpe_32k.model", decode=True).select(
        "doc_id",
        "n_bytes",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
