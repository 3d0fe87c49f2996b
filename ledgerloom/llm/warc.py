"""WARC files: one gzip member per record, written and read by byte ranges.

Writing: payload digests find repeats; of the records with equal payloads the
one with the largest page_id carries it, the others are revisit records that
refer to it. Every task writes one file.

Reading: tasks get byte ranges, not files. A task scans its range for the gzip
magic, takes a candidate only if the member's first bytes decode to a WARC
version line, and owns the records that start inside its range; the last one
may end beyond it. After one member is read whole, the next starts at its end,
so a scan is needed only at the start of a range or after damage. A member
whose checksum fails is no record. The writer makes sure that no record holds
another gzip member with a WARC line in its compressed bytes.

Cases: NULL html is an empty payload. Empty payloads are equal too. A NULL
page_id takes no part in the search for repeats and is a response. Rows that
repeat a page_id with the same payload are all written in that page's role.
NULL urls give no target line; control characters and spaces in urls are
escaped. An empty table gives no file. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, filesystem, table, write_whole
from ledgerloom.session import shared_folder, stored

MAGIC = b"\x1f\x8b\x08"
HEAD_BYTES = 1 << 12
READ_BYTES = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records carry no clock time, so that a task that runs again writes the same bytes.
DATE = "1970-01-01T00:00:00Z"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head only, with the length of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]|"))
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    record = head + block + b"\r\n\r\n"
    for level in (6, 9, 1):
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        at = member.find(MAGIC, 1)
        while at >= 0 and not starts_record(member[at : at + HEAD_BYTES]):
            at = member.find(MAGIC, at + 1)
        if at < 0:
            return member
    raise ValueError(f"page {page_id}: every encoding holds another record")


def starts_record(data: bytes) -> bool:
    """Whether a gzip member that starts here begins with a WARC version line."""
    try:
        return zlib.decompressobj(31).decompress(data, 16).startswith(b"WARC/1.")
    except zlib.error:
        return False


def parse_record(data: bytes) -> dict:
    """Fields of one decoded record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(v.split(b":", 1)[1]) for v in http.split(b"\r\n") if v.lower().startswith(b"content-length:"))
    page = lambda urn: None if urn is None or urn == "<urn:page:null>" else int(urn[len("<urn:page:") : -1])
    return {
        "page_id": page(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "record_type": fields["WARC-Type"],
        "refers_to": page(fields.get("WARC-Refers-To")),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def records_in(handle, start: int, end: int, size: int, step: int = READ_BYTES) -> Iterator[bytes]:
    """Decoded records whose members start in ``[start, end)`` of an open file."""
    window, at = b"", start

    def need(upto: int) -> None:
        nonlocal window
        if upto > len(window) and at + len(window) < size:
            missing = min(max(upto - len(window), min(step, end - at)), size - at - len(window))
            window += handle.read_at(missing, at + len(window))

    place = 0
    while at + place < end:
        if place > step:
            window, at, place = window[place:], at + place, 0
        need(place + HEAD_BYTES)
        if not (window[place : place + 3] == MAGIC and starts_record(window[place : place + HEAD_BYTES])):
            found = window.find(MAGIC, place + 1)
            if found < 0:
                if at + len(window) >= min(size, end + 2):
                    return
                place = max(len(window) - 2, place + 1)
                need(len(window) + step)
            else:
                place = found
            continue
        decoder, parts, used = zlib.decompressobj(31), [], place
        try:
            while not decoder.eof:
                need(used + 1)
                chunk = window[used : used + step]
                if not chunk:
                    raise zlib.error("cut off")
                parts.append(decoder.decompress(chunk))
                used += len(chunk) - len(decoder.unused_data)
        except zlib.error:
            place += 1
            continue
        yield b"".join(parts)
        place = used


def find_repeats(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_digest and refers_to (NULL for a response).

    The largest page_id of each digest is found by an aggregate that combines
    before the shuffle; the join back is one whose large keys Spark splits.
    """
    bounded_batches(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).withColumn(
        "_sha", F.sha1("payload")
    )
    repeats = (
        pages.where("page_id IS NOT NULL")
        .select(F.col("page_id").cast("long"), payload.alias("payload"))
        .where(F.octet_length("payload") >= min_bytes)
        .groupBy(F.sha1("payload").alias("_sha"))
        .agg(F.max("page_id").alias("_last"), F.min("page_id").alias("_first"))
        .where("_first < _last")
        .select("_sha", "_last")
    )
    revisit = (F.col("page_id") < F.col("_last")) & (F.octet_length("payload") >= min_bytes)
    return rows.join(repeats, "_sha", "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("_last")).alias("refers_to")
    )


def write_warc(rows: DataFrame, folder: str) -> DataFrame:
    """Write the rows of :func:`find_repeats`; returns path and size of each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        path = f"{base}/part-{TaskContext.get().partitionId():06d}.warc.gz"

        def members() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    page_id, url, payload, refers_to = (c[i].as_py() for c in batch.columns)
                    yield record_bytes(page_id, url, payload, base32_sha1(payload), refers_to)

        stream = members()
        first = next(stream, None)
        if first is None:
            return

        def again() -> Iterator[bytes]:
            yield first
            yield from stream

        fs.create_dir(base, recursive=True)
        size = write_whole(fs, path, again())
        yield pa.RecordBatch.from_pydict({"path": [path], "size": [size]})

    return stored(rows.mapInArrow(run, "path string, size long"), "archives")


def read_warc(files: DataFrame, folder: str, split_bytes: int = 8 << 20, payloads: bool = True) -> DataFrame:
    """All records of the files (path, size), read in ranges of ``split_bytes``."""
    splits = files.select(
        "path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    ).repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    schema = RECORDS if payloads else RECORDS.removesuffix(", payload binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        names = [f.split()[0] for f in schema.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        to = pa.schema([(f.split()[0], types[f.split()[1]]) for f in schema.split(", ")])
        for batch in batches:
            for split in batch.to_pylist():
                with fs.open_input_file(split["path"]) as handle:
                    rows, held = [], 0
                    for data in records_in(handle, split["start"], min(split["start"] + split_bytes, split["size"]), split["size"]):
                        record = parse_record(data)
                        rows.append({n: record[n] for n in names})
                        held += len(data) if payloads else 500
                        if held > READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=to)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=to)

    return splits.mapInArrow(run, schema)


def op10_warc(spark, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    files = write_warc(find_repeats(table(spark, sf_dir, "pages"), min_bytes=0), folder)
    return read_warc(files, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_OP10 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), bits AS (
  SELECT page_id, payload_bytes, h,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
      list_aggregate(list_transform(range(5), lambda j:
        (((strpos('0123456789abcdef', substr(h, 1 + (5 * i + j) // 4, 1)) - 1) >> (3 - (5 * i + j) % 4)) & 1) << (4 - j)), 'sum')::INT, 1)),
      'string_agg', '') AS payload_digest
  FROM p
), heads AS (
  SELECT h, max(page_id) AS last FROM p GROUP BY h
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM bits JOIN heads USING (h)
"""
