"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.plans.quality import high_value_orders
from ledgerloom.plans.testbed import QUERIES

LAZY = sorted(
    name
    for name in QUERIES
    if not name.startswith("stream_")
    and name not in ("star_row_counts", "store_roundtrip", "csv_ingest", "customer_transform")
)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cartesian_product(spark, small_dir, name):
    text = plan(queries()[name](spark, small_dir))
    for node in ("Python", "ArrowEval", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text, node


def test_top_k_needs_no_full_sort(spark, small_dir):
    for name in ("top_customers", "top_customers_named", "customer_spend", "preview_rows"):
        assert "TakeOrderedAndProject" in plan(queries()[name](spark, small_dir))


def test_scan_reads_only_the_needed_columns_and_pushes_the_limit(spark, small_dir, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(1000).selectExpr(
        "cast(id as string) as order_id", "cast(id as decimal(29,2)) as order_amount", "id as other"
    ).write.parquet(path)
    fact = spark.read.parquet(path)
    text = plan(high_value_orders(fact).select("order_id"))
    assert "GreaterThan(order_amount,899.00)" in text and "other" not in text.split("ReadSchema")[1]
    text = plan(queries()["sales_anomalies"](spark, small_dir)).split("== Physical Plan ==")[1]
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_facts_are_summed_before_the_join(spark, small_dir):
    text = plan(queries()["product_category_sales"](spark, small_dir))
    physical = text.split("== Physical Plan ==")[1]
    assert physical.count("HashAggregate") >= 4


def test_dedupe_thins_copies_before_the_shuffle(spark):
    df = spark.range(9).selectExpr("id % 3 as k", "id as n", "'x' as v")
    text = plan(first_per_key(df, ["k"], "n")).split("== Physical Plan ==")[1]
    assert "partial_min" in text and "Window" not in text


def test_spread_joins_hold_no_sort_by_one_task(spark, small_dir):
    text = plan(queries()["orders_enriched_salted"](spark, small_dir))
    assert "SinglePartition" not in text.split("Subquery")[0].split("== Physical Plan ==")[1]


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == [
        "order_day",
        "daily_revenue",
        "rolling_avg_7d",
        "rolling_std_7d",
        "status",
    ]
    assert df.where("status = 'ANOMALY'").count() == 12
