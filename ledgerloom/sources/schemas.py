"""Declared shape of the raw tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
UNITS = T.DecimalType(18, 0)


class Field(NamedTuple):
    """A raw column: text of at most ``width`` characters, or a decimal."""

    name: str
    dtype: T.DataType
    width: int | None = None


def text(name: str, width: int) -> Field:
    return Field(name, T.StringType(), width)


# Column names, widths and numeric types of the raw layer.
RAW_TABLES: dict[str, tuple[Field, ...]] = {
    "raw_customers": (
        text("customer_id", 50),
        text("first_name", 50),
        text("last_name", 50),
        text("email", 100),
        text("phone", 50),
        text("country", 50),
    ),
    "raw_products": (
        text("product_id", 50),
        text("product_name", 150),
        text("category", 100),
        Field("price", PRICE),
        text("currency", 10),
        Field("stock_quantity", UNITS),
    ),
    "raw_orders": (
        text("order_id", 50),
        text("customer_id", 50),
        text("product_id", 50),
        text("order_date", 25),
        Field("quantity", UNITS),
        Field("total_amount", PRICE),
        text("currency", 10),
    ),
    "raw_clicks": (
        text("click_id", 50),
        text("customer_id", 50),
        text("product_id", 50),
        text("page_url", 500),
        text("click_timestamp", 50),
        text("device_type", 50),
    ),
    "raw_support_tickets": (
        text("ticket_id", 50),
        text("customer_id", 50),
        text("issue_category", 100),
        text("created_at", 50),
        text("status", 50),
        text("resolution_time_hours", 50),
    ),
}


def text_schema(table: str) -> T.StructType:
    """All columns as text: how files are read before the casts."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_TABLES[table]])


def typed_schema(table: str) -> T.StructType:
    """Columns as they stand once loaded."""
    return T.StructType([T.StructField(f.name, f.dtype) for f in RAW_TABLES[table]])
