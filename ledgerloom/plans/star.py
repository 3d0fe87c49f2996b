"""Star schema: the conformed tables (cleaned) and the staged ones (as loaded)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.dates import calendar_columns, strict_date, tolerant_date
from ledgerloom.functions.labels import price_bucket, trimmed
from ledgerloom.operators.calendar import day_series, day_span
from ledgerloom.operators.joins import lookup_join
from ledgerloom.sources.schemas import PRICE, UNITS


def conformed_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        *trimmed("customer_id", "first_name", "last_name", "email", "phone", "country")
    )


def conformed_products(raw_products: DataFrame) -> DataFrame:
    return raw_products.select(
        *trimmed("product_id", "product_name", "category"),
        F.col("price").try_cast(PRICE).alias("price"),
        *trimmed("currency"),
        F.col("stock_quantity").try_cast(UNITS).alias("stock_quantity"),
    )


def calendar_dates(raw_orders: DataFrame, as_of: date) -> DataFrame:
    """Every day between the first and last order."""
    days = raw_orders.select(tolerant_date(F.col("order_date")).alias("dt"))
    return day_series(day_span(days, "dt", as_of)).select(*calendar_columns(F.col("d")))


def conformed_orders(raw_orders: DataFrame) -> DataFrame:
    """Typed orders; those without id, date or a quantity of at least 0 are left out."""
    typed = raw_orders.where(F.col("order_id").isNotNull()).select(
        *trimmed("order_id", "customer_id", "product_id"),
        tolerant_date(F.col("order_date")).alias("order_date"),
        F.col("quantity").try_cast(UNITS).alias("quantity"),
        F.col("total_amount").try_cast(PRICE).alias("total_amount"),
        *trimmed("currency"),
    )
    return typed.where(F.col("order_date").isNotNull() & (F.col("quantity") >= 0))


def enriched_orders(raw_orders: DataFrame, raw_products: DataFrame) -> DataFrame:
    """Orders with price and amount; both NULL where the product is unknown."""
    priced = lookup_join(raw_orders, raw_products.select("product_id", "price"), "product_id")
    return priced.select(
        *raw_orders.columns, "price", (F.col("quantity") * F.col("price")).alias("order_amount")
    )


def product_summary(raw_products: DataFrame) -> DataFrame:
    return raw_products.select("*", price_bucket(F.col("price")).alias("revenue_bucket"))


def staged_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        "customer_id", "first_name", "last_name", "email", "phone", "country"
    )


def staged_orders(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        "price",
        "order_date",
        (F.col("quantity") * F.col("price")).alias("order_amount"),
    )


def observed_dates(staged: DataFrame) -> DataFrame:
    """The days that have orders; a NULL date gives a row of NULLs.

    Texts are made distinct before they are read as days, and days before the
    other columns are derived from them.
    """
    texts = staged.select("order_date").distinct()
    days = texts.select(strict_date(F.col("order_date")).alias("d")).distinct()
    return days.select(*calendar_columns(F.col("d")))


def staged_fact(staged: DataFrame) -> DataFrame:
    return staged.select(
        "order_id", "customer_id", "product_id", "quantity", "price", "order_amount", "order_date"
    )


def typed_fact(fact: DataFrame) -> DataFrame:
    """The staged fact with a real date."""
    return fact.withColumn("order_date", strict_date(F.col("order_date")))
