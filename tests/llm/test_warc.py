"""Round trips of archives, and reading them in ranges of any size."""

from __future__ import annotations

import gzip
import io

import pytest

from ledgerloom.llm.warc import base32_sha1, find_repeats, parse_record, read_warc, record_bytes, records_in, write_warc
from ledgerloom.session import shared_folder

PAGES = [
    (1, "http://a/x y\n", "same"), (2, None, "same"), (3, "http://a/ü", "same"), (3, "http://a/ü", "same"),
    (4, "u", None), (5, "u", ""), (6, "u", "<p>\r\n\r\nWARC/1.1 in text</p>"), (None, "u", "same"), (7, "u", "long é" * 20_000),
]


class Handle:
    def __init__(self, data: bytes) -> None:
        self.data = data

    def read_at(self, n: int, at: int) -> bytes:
        return self.data[at : at + n]


def test_archive_round_trip(spark):
    folder = shared_folder(spark, "warc-test")
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, payload string")
    files = write_warc(find_repeats(pages.repartition(3)), folder)
    rows = read_warc(files, folder, split_bytes=64).collect()
    assert len(rows) == len(PAGES)
    texts = {p: (h or "").encode() for p, _, h in PAGES}
    last = {}
    for p, h in texts.items():
        if p is not None:
            last[h] = max(p, last.get(h, p))
    for r in rows:
        full = texts[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(full), base32_sha1(full))
        revisit = r.page_id is not None and last[full] > r.page_id
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == (last[full] if revisit else None)
        assert r.payload is None if revisit else bytes(r.payload) == full
    assert write_warc(find_repeats(pages.limit(0)), folder + "-none").count() == 0


@pytest.mark.parametrize("split", [1, 2, 3, 50, 301, 5000])
def test_each_record_has_one_owner(split):
    members = [record_bytes(i, "u", bytes([65 + i]) * (i * 37), "D", None) for i in range(12)]
    data = b"".join(members)
    found = []
    for start in range(0, len(data), split):
        found += [parse_record(r)["page_id"] for r in records_in(Handle(data), start, min(start + split, len(data)), len(data), step=64)]
    assert found == list(range(12))


def test_noise_and_damage_are_stepped_over():
    members = [record_bytes(i, "u", b"x" * 100, "D", None) for i in range(4)]
    damaged = members[1][:-6] + b"\0" * 6
    data = b"\x1f\x8b\x08junk" + members[0] + gzip.compress(b"not a record") + damaged + members[2] + members[3][:-3]
    assert [parse_record(r)["page_id"] for r in records_in(Handle(data), 0, len(data), len(data))] == [0, 2]


def test_members_are_plain_gzip():
    member = record_bytes(9, "u", b"body", "D", 12)
    assert gzip.GzipFile(fileobj=io.BytesIO(member)).read().startswith(b"WARC/1.1\r\nWARC-Type: revisit")
