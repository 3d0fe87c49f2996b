"""Null order, ties, frames, calendars, tiers."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.dates import tolerant_date
from ledgerloom.operators.calendar import day_series
from ledgerloom.operators.segments import tercile_segments, with_share
from ledgerloom.plans import marts, star
from ledgerloom.plans.quality import high_value_orders

AS_OF = date(2025, 9, 5)
FACT = "order_id string, customer_id string, product_id string, order_amount double"


def test_missing_revenue_heads_the_list_unless_told_otherwise(spark):
    fact = spark.createDataFrame(
        [("1", "a", "p", 5.0), ("2", "b", "p", None), ("3", "c", "p", 5.0)], FACT
    )
    assert [r.customer_id for r in marts.top_customers(fact, 2).collect()] == ["b", "a"]
    assert [r.customer_id for r in marts.top_customers(fact, 2, "last").collect()] == ["a", "c"]


def test_named_top_customers_count_distinct_orders_and_copies(spark):
    fact = spark.createDataFrame(
        [("1", "a", "p", 5.0), ("1", "a", "q", 5.0), ("2", "z", "p", 9.0)], FACT
    )
    customers = spark.createDataFrame(
        [("a", "A", "B"), ("a", "A", "B")], "customer_id string, first_name string, last_name string"
    )
    rows = marts.top_customers_named(fact, customers).collect()
    # The copy in the dimension doubles the sum, as the row-level join does.
    assert [(r.customer_id, r.total_revenue, r.total_orders) for r in rows] == [("a", 20.0, 1)]


def test_namesakes_merge_in_spend(spark):
    fact = spark.createDataFrame(
        [("1", "a", 1.0), ("2", "b", 2.0)], "order_id string, customer_id string, total_amount double"
    )
    customers = spark.createDataFrame(
        [("a", "X", "Y"), ("b", "X", "Y")], "customer_id string, first_name string, last_name string"
    )
    (row,) = marts.customer_spend(fact, customers).collect()
    assert (row.customer_name, row.total_spent, row.orders_cnt) == ("X Y", 3.0, 2)


def anomalies(spark, amounts, start=date(2024, 1, 1), skip=()):
    rows, day = [], start
    for i, amount in enumerate(amounts):
        while day in skip:
            day += timedelta(days=1)
        rows.append((day, float(amount)))
        day += timedelta(days=1)
    fact = spark.createDataFrame(rows, "order_date date, order_amount double")
    return sorted(marts.sales_anomalies(fact).collect(), key=lambda r: r.order_day)


def test_spike_on_day_six_is_found_but_not_on_day_five(spark):
    assert [r.status for r in anomalies(spark, [10] * 5 + [99])] == ["NORMAL"] * 5 + ["ANOMALY"]
    assert {r.status for r in anomalies(spark, [10] * 4 + [99])} == {"NORMAL"}
    assert anomalies(spark, [10] * 6 + [99])[-1].status == "ANOMALY"


def test_first_day_has_no_deviation(spark):
    first = anomalies(spark, [10, 11])[0]
    assert first.rolling_std_7d is None and first.status == "NORMAL"


def test_frame_counts_rows_over_a_missing_day(spark):
    rows = anomalies(spark, range(1, 9), skip=(date(2024, 1, 4),))
    assert rows[-1].rolling_avg_7d == pytest.approx(sum(range(2, 9)) / 7)


def test_unknown_day_is_last(spark):
    fact = spark.createDataFrame(
        [(date(2024, 1, 1), 1.0), (None, 7.0), (date(2024, 1, 2), 4.0)],
        "order_date date, order_amount double",
    )
    rows = {r.order_day: r for r in marts.sales_anomalies(fact).collect()}
    assert rows[date(2024, 1, 1)].rolling_avg_7d == 1.0
    assert rows[None].rolling_avg_7d == 4.0


def test_fact_keeps_zero_and_drops_negative_or_unknown_quantity(spark):
    rows = [
        ("1", "-1", "2024-01-01"),
        ("2", "0", "2024-01-01"),
        ("3", None, "2024-01-01"),
        ("4", "2", "2024-01-01"),
        ("5", "2", "bad"),
        (None, "2", "2024-01-01"),
    ]
    raw = spark.createDataFrame(rows, "order_id string, quantity string, order_date string")
    raw = raw.select(
        "*",
        *[F.lit(" x ").alias(c) for c in ("customer_id", "product_id", "currency")],
        F.lit("1.5").alias("total_amount"),
    )
    got = star.conformed_orders(raw).collect()
    assert sorted(r.order_id for r in got) == ["2", "4"]
    assert got[0].customer_id == "x"


def test_unknown_product_leaves_amount_empty(spark):
    orders = spark.createDataFrame(
        [("1", "p", 2), ("2", "q", 2)], "order_id string, product_id string, quantity int"
    )
    products = spark.createDataFrame([("p", 1.5)], "product_id string, price double")
    got = {r.order_id: r.order_amount for r in star.enriched_orders(orders, products).collect()}
    assert got == {"1": 3.0, "2": None}


def test_calendar_of_no_orders_and_of_a_long_span(spark):
    none = spark.createDataFrame([], "order_date string")
    days = star.calendar_dates(none, AS_OF)
    ends = days.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert tuple(ends) == (AS_OF - timedelta(365), AS_OF + timedelta(365), 731)
    long = spark.createDataFrame([("1950-01-01",), ("2020-01-01",)], "order_date string")
    assert star.calendar_dates(long, AS_OF).count() == (date(2020, 1, 1) - date(1950, 1, 1)).days + 1


def test_a_stray_early_date_loses_no_revenue(spark):
    rows = [("1", "c", "p", "0001-01-01", "1", "5.00", "USD"), ("2", "c", "p", "2024-01-01", "1", "7.00", "USD")]
    names = "order_id string, customer_id string, product_id string, order_date string, quantity string, total_amount string, currency string"
    raw = spark.createDataFrame(rows, names)
    months = marts.revenue_by_month(star.conformed_orders(raw), star.calendar_dates(raw, AS_OF))
    assert {r.year: float(r.revenue) for r in months.collect()} == {1: 5.0, 2024: 7.0}


def test_a_calendar_longer_than_allowed_is_an_error(spark):
    span = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 31))], "first_day date, last_day date")
    assert day_series(span, 31).count() == 31
    with pytest.raises(Exception, match="more than 30 days"):
        day_series(span, 30).count()


def test_text_that_is_no_day_of_four_digit_years(spark):
    texts = ["100000-01-01", "+20240-01-01", "2025", "0000-01-01", "2025-13-01", "2025-3-1", "2025-03-01 10:00:00", "2025/03/01", "03/01/2025"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tolerant_date(F.col("t")).alias("d")).collect()
    assert [r.d for r in rows] == [None] * 5 + [date(2025, 3, 1)] * 4


def test_unreadable_text_dates_are_one_group(spark):
    fact = spark.createDataFrame([("2024-01-01", 1.0), ("bad", 2.0), (None, 4.0)], "order_date string, order_amount double")
    assert {r.order_day: r.daily_revenue for r in marts.sales_anomalies(fact).collect()} == {date(2024, 1, 1): 1.0, None: 6.0}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        marts.sales_anomalies(fact, tolerant=False).count()


def test_rows_equal_to_the_limit_are_not_above_it(spark):
    fact = spark.createDataFrame([(Decimal("0.10"),)] * 80 + [(Decimal("0.29"),)] * 20, "order_amount decimal(10,2)")
    assert high_value_orders(fact).count() == 0


def test_readers_get_sorted_rows(spark):
    fact = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "category string, n int")
    assert [r.category for r in marts.in_reading_order(fact, "category").collect()] == ["a", "b", None]


def test_calendar_columns(spark):
    df = spark.createDataFrame([("2021-01-01",)], "order_date string")
    (row,) = star.calendar_dates(df, AS_OF).collect()
    assert (row.year, row.month_num, row.month_name, row.quarter) == (2021, "01", "Jan", 1)
    assert (row.week_of_year, row.day_of_month, row.date_iso) == (53, 1, "2021-01-01")


def test_observed_dates_keep_a_row_for_missing_dates(spark):
    df = spark.createDataFrame([("2021-01-01",), ("2021-01-01",), (None,)], "order_date string")
    assert {r.date_key for r in star.observed_dates(df).collect()} == {date(2021, 1, 1), None}


def test_value_on_an_edge_falls_in_the_lower_tier(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 5)], "x double")
    got = {r.x: r.segment for r in tercile_segments(df, "x").collect()}
    assert got == {1.0: "Low", 2.0: "Low", 3.0: "Medium", 4.0: "High"}


def test_equal_edges_are_an_error(spark):
    df = spark.createDataFrame([(1.0,)] * 6, "x double")
    with pytest.raises(ValueError, match="not distinct"):
        tercile_segments(df, "x")


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "c string, r double")
    assert {r.c: r.share for r in with_share(df, "r").collect()} == {"a": 0.25, "b": 0.75}


def test_trend_of_a_straight_line(spark):
    rows = [(date(2024, 1, 1) + timedelta(i), 10.0 + 2 * i) for i in range(10)]
    fact = spark.createDataFrame(rows, "order_date date, order_amount double")
    got = sorted(marts.sales_trend(fact, 3).collect())
    assert [r.expected_revenue for r in got] == pytest.approx([30.0, 32.0, 34.0])
    assert got[0].forecast_day == date(2024, 1, 11)


def test_new_customers_per_day(spark):
    rows = [("a", date(2024, 1, 1)), ("b", date(2024, 1, 1)), ("c", None)]
    df = spark.createDataFrame(rows, "customer_id string, signup_date date")
    got = {r.signup_date: r.new_customers for r in marts.new_customers_daily(df).collect()}
    assert got == {date(2024, 1, 1): 2, None: 1}
