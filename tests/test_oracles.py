"""Every registered query against its SQL, whole tables, order ignored."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from ledgerloom.plans.testbed import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def views(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def db(sf_dir):
    return views(sf_dir)


@pytest.fixture(scope="module")
def small_db(small_dir):
    return views(small_dir)


def plain(value):
    if isinstance(value, datetime):
        return value.date().isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def compare(spark, db, sf_dir, name):
    result = queries()[name](spark, sf_dir)
    got = sorted_rows(result.columns, result.collect())
    assert got
    if name not in oracle_sql():
        return
    cursor = db.execute(oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    want = sorted_rows(names, cursor.fetchall())
    assert sorted(result.columns) == sorted(names)
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, f"{len(different)} of {len(got)} rows differ: {different[:3]}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, sf_dir, name):
    compare(spark, db, sf_dir, name)


# Queries with another way for tables past the broadcast or single-task bounds.
LARGE = (
    "all_customer_segments",
    "csv_ingest",
    "fact_orders_conformed",
    "category_share",
    "high_value_orders",
    "high_value_orders_tied",
    "issue_log",
    "issue_log_known_prices",
    "orders_enriched",
    "orphan_counts",
    "orphan_imputed",
    "orphan_orders",
    "outlier_imputed_stepwise",
    "product_category_sales",
    "revenue_by_month",
    "star_row_counts",
    "store_roundtrip",
    "stream_alerts",
    "stream_enriched",
    "top_customers_named",
)


@pytest.mark.parametrize("name", LARGE)
def test_query_equals_sql_as_for_large_tables(spark, small_db, small_dir, name):
    """No lookup may be broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold",)
    keep = {k: spark.conf.get(k) for k in keys}
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        compare(spark, small_db, small_dir, name)
    finally:
        for key, value in keep.items():
            spark.conf.set(key, value)
