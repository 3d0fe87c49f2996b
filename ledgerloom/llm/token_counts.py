"""Token counts of whole texts; huge texts are encoded in overlapping chunks.

Memory of a task is bounded by a chunk, not by the longest text. A chunk
boundary falls anywhere, so the end of one chunk and the start of the next are
encoded wrongly. The two encodings are spliced at a common stable boundary: a
place in the overlap where both end a word. It is proven stable when

* both chunks end a word of the splitting pattern there (a token with the
  word-end suffix, or an added token, ends at that place in the text). The
  pattern never looks back, so from such a place on the encoding depends on the
  text that follows only;
* it lies ``MARGIN`` characters or more before the end of the earlier chunk, so
  neither the pattern's look-ahead nor an added token can reach past that end;
* the next character is ASCII: no normalisation composes it with what precedes.

Tokens of the earlier chunk before the place, and of the later one from it on,
are those of the whole text. Without such a place the overlap is doubled, up to
the whole rest of the text.

Texts up to a chunk are counted by their parts between spaces, each distinct
part encoded once: the pattern drops white space and no word reaches across it.

Cases: NULL is an empty text (0 bytes, 0 tokens). Rows are independent, so
repeated rows and other columns do not matter; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import KEPT, bounded_batches, one_thread, slices, table, tidy, tokenizer_path
from ledgerloom.llm.unit_cache import UnitCache

CHUNK, OVERLAP, MARGIN = 32_768, 1_024, 64
BATCH_BYTES = 2 << 20
#: Parts whose counts a worker keeps.
KEPT_PARTS = 300_000


class ChunkedCounter:
    """Counts (or lists) the token ids of texts of any length."""

    def __init__(self, name: str, chunk: int = CHUNK, overlap: int = OVERLAP, margin: int = MARGIN) -> None:
        one_thread()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        added = self.tokenizer.get_added_tokens_decoder()
        self.margin = max([margin, *(2 * len(t.content) for t in added.values())])
        suffix = self.tokenizer.model.end_of_word_suffix
        if not suffix:
            raise ValueError("the chunked way needs a vocabulary with word ends")
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.ends_word[list(added)] = True

        self.known = UnitCache(self._sizes, KEPT_PARTS)

    def _sizes(self, parts: list[str]) -> list[list[int]]:
        return [[len(e)] for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Numbers of tokens of texts that need no chunks."""
        parts: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            parts += text.split(" ")
            ends[i + 1] = len(parts)
        n, _ = self.known.numbers(parts)
        return np.diff(np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[ends])

    def _encode(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a chunk, where in the text each token ends, and the word ends among those places."""
        found = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        ends = start + np.array([e for _, e in found.offsets], np.int64)
        return ids, ends, np.unique(ends[self.ends_word[ids]])

    def _splice(self, text: str, left: np.ndarray, right: np.ndarray, start: int, end: int) -> int | None:
        """Last proven common boundary of two chunks, the later starting at ``start``, the earlier ending at ``end``."""
        common = np.intersect1d(left, right, assume_unique=True)
        for place in common[(common > start) & (common <= end - self.margin)][::-1]:
            if text[place].isascii():
                return int(place)
        return None

    def ids(self, text: str) -> np.ndarray:
        """All ids of a text."""
        if len(text) <= self.chunk:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)
        return np.concatenate(list(self.pieces(text)))

    def pieces(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text, chunk by chunk."""
        end = min(self.chunk, len(text))
        ids, ends, words = self._encode(text, 0, end)
        begin = 0
        while end < len(text):
            overlap = self.overlap
            while True:
                start, stop = max(0, end - overlap), min(len(text), end - overlap + self.chunk + overlap)
                more, more_ends, more_words = self._encode(text, start, stop)
                place = self._splice(text, words, more_words, max(start, begin), end)
                if place is not None:
                    break
                if start <= begin:
                    # No boundary in all that is not given out yet: take a longer chunk from its start.
                    stop = min(len(text), end + self.chunk)
                    more, more_ends, more_words = self._encode(text, begin, stop)
                    place = begin
                    break
                overlap *= 2
            if place > begin:
                yield ids[(ends > begin) & (ends <= place)]
            begin, end = place, stop
            ids, ends, words = more, more_ends, more_words
        yield ids[ends > begin] if begin else ids

    def count(self, text: str) -> int:
        return sum(map(len, self.pieces(text)))


@lru_cache(maxsize=1)
def worker_counter(name: str) -> ChunkedCounter:
    """The counter of this worker process; tasks that follow find its parts."""
    own = ChunkedCounter(name)
    KEPT.append(own.known.clear)
    return own


def token_counts(docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether there are more than ``limit`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = np.zeros(len(texts), np.int64)
            short = [i for i, t in enumerate(texts) if len(t) <= counter.chunk]
            for a, b in slices([len(texts[i]) for i in short], BATCH_BYTES):
                own = short[a:b]
                tokens[own] = counter.counts([texts[i] for i in own])
            for i, text in enumerate(texts):
                if len(text) > counter.chunk:
                    tokens[i] = counter.count(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens)], names=["doc_id", "n_bytes", "n_tokens"]
            )

    bounded_batches(docs.sparkSession)
    sized = docs.select(
        F.col("doc_id").cast("long"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = sized.mapInArrow(tidy(run, keeps=True), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), "word_bpe_49k.json", 2048)
