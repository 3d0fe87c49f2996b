"""Token ids in files of fixed-width packed bits, with random access.

Each id takes the fewest bits that hold every id of the vocabulary. Eight ids
fill exactly ``bits`` bytes, so packing and unpacking are a few shifts over
whole columns. Blocks of ``BLOCK`` ids have equal size; the file keeps their
places, the documents' places, and can be read from any document on.

File: payload blocks | block offsets (u64) | doc ids (i64) | NULL marks (u8) |
document places in ids, n + 1 (u64) | JSON footer | its length (u32) | magic.

Cases: a NULL or empty text is a document of the end id alone. Rows with equal
doc_id are all kept, ordered by their text. NULL doc_ids come first. An empty
table gives no file. Other columns of the input are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.byte_ids import encoder
from ledgerloom.llm.common import bounded_batches, filesystem, packed, slices, table, tidy, write_whole
from ledgerloom.session import shared_folder, stored

MAGIC = b"LLBITS01"
BLOCK = 4096
ENCODE_BYTES = 2 << 20
KEPT_WORDS = 700_000
MANIFEST = "part int, path string, n_docs long, n_ids long"


def bits_for(n_values: int) -> int:
    """Bits that hold every value below ``n_values``."""
    return max(1, int(n_values - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other, lowest bit first; the last byte is filled with zeros."""
    n = len(ids)
    rows = np.zeros((-(-n // 8), 8), np.uint64)
    rows.reshape(-1)[:n] = ids
    out = np.zeros((len(rows), bits), np.uint8)
    for byte in range(bits):
        value = np.zeros(len(rows), np.uint64)
        for i in range(8 * byte // bits, min(8, -(-8 * (byte + 1) // bits))):
            shift = i * bits - 8 * byte
            value |= rows[:, i] << np.uint64(shift) if shift >= 0 else rows[:, i] >> np.uint64(-shift)
        out[:, byte] = value.astype(np.uint8)
    return out.tobytes()[: -(-n * bits // 8)]


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of packed ``data``."""
    rows = np.zeros((-(-n // 8), bits), np.uint8)
    have = np.frombuffer(data, np.uint8)[: rows.size]
    rows.reshape(-1)[: len(have)] = have
    out = np.zeros((len(rows), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for i in range(8):
        value = np.zeros(len(rows), np.uint64)
        for byte in range(i * bits // 8, -(-(i + 1) * bits // 8)):
            shift = 8 * byte - i * bits
            own = rows[:, byte].astype(np.uint64)
            value |= own << np.uint64(shift) if shift >= 0 else own >> np.uint64(-shift)
        out[:, i] = (value & mask).astype(np.uint32)
    return out.reshape(-1)[:n]


def file_chunks(docs: Iterator[tuple[list, np.ndarray, np.ndarray]], bits: int, seen: dict) -> Iterator[bytes]:
    """Bytes of one file from batches of (doc ids, ids, document places); ``seen`` gets the counts."""
    waiting, n_ids, offsets, size = np.zeros(0, np.uint32), 0, [], 0
    doc_ids: list = []
    lengths = [np.zeros(0, np.int64)]
    for names, ids, at in docs:
        doc_ids += names
        lengths.append(np.diff(at))
        n_ids += len(ids)
        waiting = np.concatenate([waiting, ids])
        whole = len(waiting) // BLOCK * BLOCK
        if whole:
            data = pack(waiting[:whole], bits)
            offsets += range(size, size + len(data), BLOCK * bits // 8)
            size += len(data)
            waiting = waiting[whole:]
            yield data
    if len(waiting):
        data = pack(waiting, bits)
        offsets.append(size)
        size += len(data)
        yield data
    places = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<u8")
    yield np.array(offsets, "<u8").tobytes()
    yield np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    yield np.array([d is None for d in doc_ids], np.uint8).tobytes()
    yield places.tobytes()
    footer = packed({"bits": bits, "block": BLOCK, "n_docs": len(doc_ids), "n_ids": n_ids, "n_blocks": len(offsets), "payload": size})
    yield footer + len(footer).to_bytes(4, "little") + MAGIC
    seen.update(n_docs=len(doc_ids), n_ids=n_ids)


class BitFile:
    """Random access to one file; only the asked blocks are read."""

    def __init__(self, handle) -> None:
        self.handle = handle
        size = handle.size()
        tail = handle.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError("not a file of packed ids")
        length = int.from_bytes(tail[:4], "little")
        self.head = json.loads(handle.read_at(length, size - 12 - length))
        self.bits, self.n_docs, self.n_ids = self.head["bits"], self.head["n_docs"], self.head["n_ids"]
        self.index = self.head["payload"] + 8 * self.head["n_blocks"]

    def documents(self, first: int, last: int) -> tuple[list, np.ndarray, np.ndarray]:
        """Doc ids, document places in the file (n + 1) and the ids of documents ``first`` to ``last - 1``."""
        n, base = self.n_docs, self.index
        names = np.frombuffer(self.handle.read_at(8 * (last - first), base + 8 * first), "<i8")
        null = np.frombuffer(self.handle.read_at(last - first, base + 8 * n + first), np.uint8)
        at = np.frombuffer(self.handle.read_at(8 * (last - first + 1), base + 9 * n + 8 * first), "<u8").astype(np.int64)
        return [None if z else int(d) for d, z in zip(names, null, strict=True)], at, self.ids(int(at[0]), int(at[-1]))

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids at places ``first`` to ``last - 1`` of the file."""
        if first >= last:
            return np.zeros(0, np.uint32)
        low, high = first // BLOCK, (last - 1) // BLOCK + 1
        offsets = np.frombuffer(self.handle.read_at(8 * (high - low), self.head["payload"] + 8 * low), "<u8")
        count = min(high * BLOCK, self.n_ids) - low * BLOCK
        data = self.handle.read_at(-(-count * self.bits // 8), int(offsets[0]))
        return unpack(data, count, self.bits)[first - low * BLOCK : last - low * BLOCK]


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write files in ascending doc_id order.

    Texts are dealt by ranges of doc_id and sorted inside; each task encodes
    and writes one file. Returns one row per file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(vocabulary, KEPT_WORDS)
        fs, base = filesystem(folder)
        part = TaskContext.get().partitionId()
        seen: dict = {}

        def encoded() -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
            for batch in batches:
                names, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
                for a, b in slices(list(map(len, texts)), ENCODE_BYTES):
                    ids, at = codec.encode(texts[a:b])
                    yield names[a:b], np.insert(ids, at[1:], end_id).astype(np.uint32), at + np.arange(len(at))

        rows = encoded()
        first = next(rows, None)
        if first is None:
            return
        fs.create_dir(base, recursive=True)
        path = f"{base}/part-{part:06d}.bits"

        def again() -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
            yield first
            yield from rows

        write_whole(fs, path, file_chunks(again(), bits_for(codec.n_ids), seen))
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "path": [path], "n_docs": [seen["n_docs"]], "n_ids": [seen["n_ids"]]}
        )

    bounded_batches(docs.sparkSession)
    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    written = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(tidy(run, keeps=True), MANIFEST)
    return stored(written, "manifest")


def read_ids(manifest: DataFrame, folder: str, docs_per_task: int = 20_000, with_ids: bool = False) -> DataFrame:
    """Read files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked, the ids."""
    splits = (
        manifest.withColumn("before", F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(docs_per_task).cast("long"))))
        .select("path", F.coalesce("before", F.lit(0)).alias("before"), "first", F.least(F.col("first") + docs_per_task, "n_docs").alias("last"))
        .repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "first")
    )
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for split in batch.to_pylist():
                with fs.open_input_file(split["path"]) as handle:
                    opened = BitFile(handle)
                    for first in range(split["first"], split["last"], 1000):
                        names, at, ids = opened.documents(first, min(first + 1000, split["last"]))
                        data = ids.astype("<u4")
                        local = at - at[0]
                        columns = {
                            "doc_id": pa.array(names, pa.int64()),
                            "start": pa.array(at[:-1] + split["before"]),
                            "n_tokens": pa.array(np.diff(at)),
                            "ids_crc32": pa.array([zlib.crc32(data[a:b]) for a, b in zip(local[:-1], local[1:], strict=True)], pa.int64()),
                        }
                        if with_ids:
                            columns["ids"] = pa.ListArray.from_arrays(pa.array(local, pa.int32()), pa.array(ids, pa.int32()))
                        yield pa.RecordBatch.from_pydict(columns)

    return splits.mapInArrow(run, schema)


def op8_bit_files(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark, 'bits')}-{uuid.uuid4().hex[:8]}"
    manifest = write_ids(table(spark, sf_dir, "documents"), folder, "byte_bpe_50k.json")
    return read_ids(manifest, folder)
