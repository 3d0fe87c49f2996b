"""Dates, names, buckets."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.dates import iso_date_or_null, strict_date, tolerant_date
from ledgerloom.functions.labels import full_name, price_bucket
from ledgerloom.plans.star import observed_dates

DAY = date(2025, 1, 31)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2025-01-31", DAY),
        ("2025/01/31", DAY),
        ("01/31/2025", DAY),
        ("2025-01-31 10:00:00", DAY),
        (" 2025-01-31 ", DAY),
        ("31/01/2025", None),
        ("2025/13/01", None),
        ("2025/1/31", None),
        ("bad", None),
        ("", None),
        (None, None),
    ],
)
def test_tolerant_date(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tolerant_date(F.col("t"))).first()[0] == want


def test_tolerant_date_follows_the_pattern_chain(spark):
    """The single cast gives what trying the patterns one by one gives."""
    texts = [
        f"{y}{a}{m}{a}{d}" for y in ("1999", "2024", "0001") for m in ("02", "12", "13", "00")
        for d in ("28", "29", "31", "00") for a in "-/"
    ] + [f"{m}/{d}/{y}" for y in ("1999", "2024") for m in ("02", "13") for d in ("28", "29", "30")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    chain = F.coalesce(
        *[F.try_to_date("t", p) for p in ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy")],
        F.col("t").try_cast("date"),
    )
    rows = df.select("t", chain.alias("a"), tolerant_date(F.col("t")).alias("b"))
    assert rows.where(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def test_strict_date_fails_on_bad_text(spark):
    good = spark.createDataFrame([("2025-01-31",), (None,)], "t string")
    assert [r[0] for r in good.select(strict_date(F.col("t"))).collect()] == [DAY, None]
    bad = spark.createDataFrame([("bad",)], "t string")
    with pytest.raises(Exception, match="CANNOT_PARSE|CAST_INVALID|could not be parsed"):
        bad.select(strict_date(F.col("t"))).collect()


def test_iso_date_or_null(spark):
    df = spark.createDataFrame([("2025-01-31",), ("01/31/2025",), ("2025-1-31",)], "t string")
    got = [r[0] for r in df.select(iso_date_or_null(F.col("t"))).collect()]
    assert got == [DAY, None, None]


def test_price_buckets(spark):
    df = spark.createDataFrame([(100.0,), (99.99,), (50.0,), (49.99,), (None,)], "p double")
    got = [r[0] for r in df.select(price_bucket(F.col("p"))).collect()]
    assert got == ["High", "Medium", "Medium", "Low", "Low"]


def test_full_name_needs_both_parts(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None)], "first_name string, last_name string")
    assert [r[0] for r in df.select(full_name()).collect()] == ["A B", None]


def test_dates_ask_for_the_usual_shape_first_and_read_each_text_once(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-02",), (None,)], "order_date string")
    parsed = df.select(tolerant_date(F.col("order_date")).alias("d"))
    plan = parsed._jdf.queryExecution().analyzed().toString()
    assert plan.index("[T ]") < plan.index(r"\d{4}/")
    days = observed_dates(df)
    assert days._jdf.queryExecution().analyzed().toString().count("Deduplicate") == 2
    assert sorted(r.date_iso or "" for r in days.collect()) == ["", "2024-01-02"]
