"""Quoted CSV read range by range, against the reader that takes a file as a whole."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import csv_files
from ledgerloom.sources.csv_files import land_csv, read_csv_text
from ledgerloom.sources.csv_ranges import _lines, _states, csv_records

HEADER = "product_id,product_name,category,price,currency,stock_quantity\n"
NAMES = [c for c in HEADER.strip().split(",")]


@pytest.fixture
def small_ranges(spark):
    """Scan ranges of a few bytes, one to a task."""
    keys = {"spark.sql.files.maxPartitionBytes": "499b", "spark.sql.files.openCostInBytes": "499b"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def fields(df):
    return [tuple(r[n] for n in NAMES) for r in df.orderBy("ingest_order").collect()]


def random_rows(seed, n):
    r = random.Random(seed)
    texts = ["plain", "two\nlines", 'a ""word"" in\n\n"" it', " , \n,", "", "NULL", " padded ", 'say ""', '""\n""', "é\nü", "x" * 300 + "\n" + "y" * 200]
    rows = []
    for i in range(n):
        row = [f"P{i}"]
        for _ in range(5):
            t = r.choice(texts)
            quoted = "\n" in t or "," in t or '"' in t or r.random() < 0.3
            row.append(("  " if r.random() < 0.1 else "") + f'"{t}"' if quoted else t)
        if r.random() < 0.1:
            row = row[: r.randint(1, 5)]
        if r.random() < 0.1:
            row.append("more")
        rows.append(",".join(row))
        if r.random() < 0.05:
            rows.append("")
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_whole_file_reader(spark, tmp_path, small_ranges, seed):
    for part in range(2):
        (tmp_path / f"{part}.csv").write_text(HEADER + "\n".join(random_rows(seed * 10 + part, 100)) + "\n" * part)
    ranged = read_csv_text(spark, str(tmp_path), "raw_products", "ranges")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    whole = read_csv_text(spark, str(tmp_path), "raw_products")
    want, got = fields(whole), fields(ranged)
    assert len(want) > 150 and got == want


def test_a_record_over_many_ranges_and_quotes_inside_plain_fields(spark, tmp_path, small_ranges):
    long = "\n".join(f'line {i} with ""quotes"", commas' for i in range(60))
    text = HEADER + f'P1,"{long}",c,1,USD,2\n' + 'P2,5" pipe,c,1,USD,3\n' + f'P3,6" and 7",c,1,USD,"{long}"\n' + 'P4,"a","b""",1,"U\nD",4\n'
    (tmp_path / "a.csv").write_text(text)
    records = csv_records(spark, str(tmp_path))
    assert records.count() == 4
    ranged = fields(read_csv_text(spark, str(tmp_path), "raw_products", "ranges"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert ranged == fields(read_csv_text(spark, str(tmp_path), "raw_products"))
    assert [r[0] for r in ranged] == ["P1", "P2", "P3", "P4"] and ranged[0][1] == long.replace('""', '"')


def test_large_files_take_the_way_by_ranges(spark, tmp_path, small_ranges, monkeypatch):
    (tmp_path / "a.csv").write_text(HEADER + "\n".join(f'P{i},"a\nb",c,1,USD,2' for i in range(50)) + "\n")
    seen = []
    plain = csv_files.csv_records
    monkeypatch.setattr(csv_files, "csv_records", lambda *a: seen.append(a) or plain(*a))
    good, bad = land_csv(spark, str(tmp_path / "a.csv"), "raw_products", str(tmp_path / "out"))
    assert seen and bad.count() == 0
    assert sorted((r.product_id, r.product_name) for r in good.collect()) == sorted((f"P{i}", "a\nb") for i in range(50))


def test_empty_and_unclosed_files(spark, tmp_path, small_ranges):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text(HEADER)
    (tmp_path / "open.csv").write_text(HEADER + 'P1,"never closed,c,1,USD,2\nP2,x,c,1,USD,3')
    rows = csv_records(spark, str(tmp_path)).collect()
    assert [r.record for r in rows] == ['P1,"never closed,c,1,USD,2\nP2,x,c,1,USD,3']


def test_a_task_reads_several_small_ranges(spark, tmp_path, small_ranges):
    for part in range(2):
        (tmp_path / f"{part}.csv").write_text(HEADER + "\n".join(random_rows(part + 5, 150)) + "\n")
    lines = _lines(spark, str(tmp_path))
    ranges = lines.select("file", "block").distinct().count()
    tasks = lines.select(F.spark_partition_id()).distinct().count()
    assert ranges > 40 and tasks <= spark.sparkContext.defaultParallelism


def test_states_compose_as_lines_do():
    r = np.random.default_rng(5)
    for _ in range(200):
        n = int(r.integers(0, 12))
        f = r.integers(0, 2, (2, n)).astype(np.int8)
        for start in (0, 1):
            want = [start]
            for i in range(n):
                want.append(int(f[want[-1], i]))
            assert _states(f[0], f[1], start).tolist() == want
