"""Datasets of the sales dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.operators.segments import segment_totals, tercile_segments, with_share
from ledgerloom.plans.marts import category_sales, top_customers
from ledgerloom.plans.quality import high_value_orders
from ledgerloom.session import stored


def customer_segments(fact: DataFrame) -> DataFrame:
    """Revenue tiers of the top customers; their few rows are stored first and ordered at once."""
    top = stored(top_customers(fact), "top-customers")
    return tercile_segments(top, "total_revenue", bracketed=False)


def segment_revenue(fact: DataFrame) -> DataFrame:
    return segment_totals(customer_segments(fact), "total_revenue")


def category_share(fact: DataFrame, products: DataFrame) -> DataFrame:
    return with_share(category_sales(fact, products), "category_revenue")


def datasets(fact: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """All five datasets by name."""
    return {
        "top_customers": top_customers(fact),
        "category_share": category_share(fact, products),
        "customer_segments": customer_segments(fact),
        "segment_revenue": segment_revenue(fact),
        "high_value_orders": high_value_orders(fact),
    }
