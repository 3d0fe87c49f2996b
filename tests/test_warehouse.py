"""From dirty CSV files to the served marts."""

from __future__ import annotations

import uuid
from datetime import date
from decimal import Decimal

import pytest

from ledgerloom.plans import dashboard
from ledgerloom.plans.warehouse import build_warehouse, gate
from ledgerloom.sources.csv_files import land_csv
from ledgerloom.sources.schemas import typed_schema
from ledgerloom.sources.store import open_database

CUSTOMERS = """CUSTOMER_ID,FIRST_NAME,LAST_NAME,EMAIL,PHONE,COUNTRY
c2,Bo,Berg,b@example.com,2,NO
customer_id,first_name,last_name,email,phone,country
c1,Al,Aas,a@example.com,1,NO
c2,Bo,Berg,b@example.com,2,NO
"""
PRODUCTS = """product_id,product_name,category,price,currency,stock_quantity
p1,Lamp,Home,10.00,USD,5
p2,Chair,Home,100.00,USD,5
p3,Pen,Office,free,USD,5
"""
ORDER_HEADER = "order_id,customer_id,product_id,order_date,quantity,total_amount,currency\n"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("shop")
    orders = [f"o{i:02d},c1,p1,2024-01-{i + 1:02d},2,20.00,USD" for i in range(20)]
    orders += ["o20,c2,p2,2024-01-21,1,100.00,USD", "o21,c9,p2,2024-01-21,1,100.00,USD"]
    orders += ["o22,c2,p3,2024-01-22,1,5.00,USD", "o23,c2,p2,2024-01-22,900,90000.00,USD"]
    files = {
        "raw_customers": CUSTOMERS,
        "raw_products": PRODUCTS,
        "raw_orders": ORDER_HEADER + "\n".join(orders) + "\n",
    }
    raw = {}
    for name, text in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text(text)
        raw[name], _ = land_csv(
            spark, str(tmp_path / name), name, str(tmp_path / f"{name}_landed")
        )
    database = f"w_{uuid.uuid4().hex}"
    open_database(spark, database, str(tmp_path / "db"))
    yield build_warehouse(raw, database, "run-1", date(2025, 9, 5), enforce_keys=True)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_chain(built):
    assert built["dim_customers"].count() == 2
    assert built["dim_products"].count() == 2  # the product without a price is in quarantine
    assert built["fact_orders"].count() == built["fact_orders_clean"].count() == 24
    assert built["dim_date"].count() == 22 and built["dim_date_conformed"].count() == 22

    clean = {r.order_id: r for r in built["fact_orders_clean"].collect()}
    assert clean["o21"].customer_id == "-1" and clean["o22"].product_id == "-1"
    assert clean["o22"].price is None and clean["o22"].order_amount is None
    assert clean["o23"].quantity == 2.0 and clean["o00"].order_date == date(2024, 1, 1)

    issues = sorted((r.issue_type, r.order_id) for r in built["data_quality_issues"].collect())
    assert issues == [
        ("orphan_customer_id", "o21"),
        ("orphan_product_id", "o22"),
        ("outlier_quantity", "o23"),
    ]

    # A customer listed twice in the file is counted once.
    named = [(r.customer_name, r.total_orders) for r in built["vw_top_customers"].collect()]
    assert named == [("Bo Berg", 3), ("Al Aas", 20)]
    top = built["top_customers"].first()
    assert (top.customer_id, top.total_revenue) == ("c2", Decimal("90100.00"))
    sales = built["product_category_sales"].collect()
    assert [(r.category, r.category_revenue) for r in sales] == [("Home", Decimal("90600.00"))]
    assert built["anomalies"].count() == 22
    months = built["revenue_by_month"].collect()
    assert [(r.year, r.month_num, r.month_name) for r in months] == [(2024, "01", "Jan")]


def test_gate_passes_on_the_build(built):
    dimensions = {
        "customer_id": built["dim_customers"],
        "product_id": built["dim_products"],
    }
    assert gate(built["fact_orders"], dimensions) == []


def test_dashboard_datasets(built):
    sets = dashboard.datasets(built["fact_orders_clean"], built["dim_products"])
    tiers = {r.customer_id: r.segment for r in sets["customer_segments"].collect()}
    assert tiers == {"c2": "High", "c1": "Medium", "-1": "Low"}
    assert sum(r.members for r in sets["segment_revenue"].collect()) == 3
    assert [r.share for r in sets["category_share"].collect()] == [1.0]
    # Rank 19.8 of the 23 known amounts lies between 20 and 100.
    high = sorted(r.order_id for r in sets["high_value_orders"].collect())
    assert high == ["o20", "o21", "o23"]


def test_repeated_order_ids_stop_the_marts(spark, tmp_path):
    raw = {
        "raw_customers": spark.createDataFrame([], typed_schema("raw_customers")),
        "raw_products": spark.createDataFrame([], typed_schema("raw_products")),
        "raw_orders": spark.createDataFrame(
            [("o1", "c", "p", "2024-01-01", Decimal(1), Decimal(1), "USD")] * 2,
            typed_schema("raw_orders"),
        ),
    }
    database = f"w_{uuid.uuid4().hex}"
    open_database(spark, database, str(tmp_path / "db"))
    with pytest.raises(ValueError, match="unique:order_id"):
        build_warehouse(raw, database, "run-1", date(2025, 9, 5), enforce_keys=True)
    spark.sql(f"DROP DATABASE {database} CASCADE")
