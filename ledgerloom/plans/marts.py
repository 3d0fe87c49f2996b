"""Served marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.labels import full_name
from ledgerloom.operators.dedupe import topmost
from ledgerloom.operators.rolling import daily_totals, rolling_anomalies


def top_customers(fact: DataFrame, k: int = 10, nulls: str = "first") -> DataFrame:
    """Largest revenue per customer."""
    revenue = fact.groupBy("customer_id").agg(F.sum("order_amount").alias("total_revenue"))
    return topmost(revenue, "total_revenue", "customer_id", k, nulls)


def top_customers_named(
    fact: DataFrame, customers: DataFrame, k: int = 10, nulls: str = "first"
) -> DataFrame:
    """Largest revenue per known customer, with name and number of orders.

    Facts are summed per customer before the join: the join then sees one row
    per customer, however many orders a customer has. Orders are counted for
    the ``k`` customers only, so the order ids of all others are not shuffled.
    """
    revenue = fact.groupBy("customer_id").agg(F.sum("order_amount").alias("revenue"))
    names = customers.select("customer_id", full_name().alias("customer_name"))
    # A customer listed twice under one name counts twice in the revenue.
    merged = (
        revenue.join(names, "customer_id")
        .groupBy("customer_id", "customer_name")
        .agg(F.sum("revenue").alias("total_revenue"))
    )
    top = topmost(merged, "total_revenue", ["customer_id", "customer_name"], k, nulls)
    chosen = F.broadcast(top.select("customer_id").distinct())  # at most k rows
    orders = (
        fact.select("customer_id", "order_id")
        .join(chosen, "customer_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.count_distinct("order_id").alias("total_orders"))
    )
    counted = top.join(F.broadcast(orders), "customer_id")
    return topmost(counted, "total_revenue", ["customer_id", "customer_name"], k, nulls)


def customer_spend(
    fact: DataFrame, customers: DataFrame, k: int = 10, nulls: str = "first"
) -> DataFrame:
    """Largest spend per customer name; namesakes are merged."""
    sums = fact.groupBy("customer_id").agg(
        F.sum("total_amount").alias("spent"), F.count("*").alias("orders")
    )
    names = customers.select("customer_id", full_name().alias("customer_name"))
    merged = (
        sums.join(names, "customer_id")
        .groupBy("customer_name")
        .agg(F.sum("spent").alias("total_spent"), F.sum("orders").alias("orders_cnt"))
    )
    return topmost(merged, "total_spent", "customer_name", k, nulls)


def category_revenue(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category of sold quantities (product_id, quantity).

    Quantities are summed per product first; one join then brings price and
    category, so neither the lines nor a hot product meet the join.
    """
    sums = sales.groupBy("product_id").agg(F.sum("quantity").alias("sold"))
    return (
        sums.join(products.select("product_id", "category", "price"), "product_id")
        .groupBy("category")
        .agg(F.sum(F.col("sold") * F.col("price")).alias("category_revenue"))
    )


def category_sales(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category of the known products, summed per product first."""
    sums = fact.groupBy("product_id").agg(F.sum("order_amount").alias("revenue"))
    return (
        sums.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("revenue").alias("category_revenue"))
    )


def sales_anomalies(fact: DataFrame, tolerant: bool = True) -> DataFrame:
    """Daily revenue against its rolling week.

    Text dates in no known layout form the group without a day; with
    ``tolerant=False``, as the model has it, they fail the query.
    """
    return rolling_anomalies(daily_totals(fact, "order_date", "order_amount", tolerant))


def revenue_by_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue per month of the calendar, summed per day first."""
    days = fact.groupBy("order_date").agg(F.sum("total_amount").alias("revenue"))
    months = dates.select("date_key", "year", "month_num", "month_name")
    return (
        days.join(months, days["order_date"] == months["date_key"])
        .groupBy("year", "month_num", "month_name")
        .agg(F.sum("revenue").alias("revenue"))
    )


def in_reading_order(df: DataFrame, *columns: str) -> DataFrame:
    """A served table in the order its readers ask for; NULL comes last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def new_customers_daily(customers: DataFrame) -> DataFrame:
    """Sign-ups per day."""
    return customers.groupBy("signup_date").agg(F.count("*").alias("new_customers"))


def customers_by_country(customers: DataFrame) -> DataFrame:
    return customers.groupBy("country").agg(F.count("*").alias("total_customers"))


def with_full_name(customers: DataFrame) -> DataFrame:
    """The customer transform: all columns plus the full name."""
    return customers.select("*", full_name().alias("full_name"))


def sales_trend(fact: DataFrame, days_ahead: int = 30) -> DataFrame:
    """Linear trend of daily revenue, carried on past the last day.

    A least-squares line over (day number, revenue): one row of statistics, then
    one row per forecast day.
    """
    totals = daily_totals(fact, "order_date", "order_amount").where(
        F.col("order_day").isNotNull()
    )
    x = F.unix_date("order_day")
    y = F.col("daily_revenue").cast("double")
    line = totals.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.max("order_day").alias("last_day"),
    )
    ahead = F.sequence(F.date_add("last_day", 1), F.date_add("last_day", days_ahead))
    days = line.select("*", F.explode(ahead).alias("forecast_day"))
    expected = F.col("intercept") + F.col("slope") * F.unix_date("forecast_day")
    return days.select("forecast_day", expected.alias("expected_revenue"))
