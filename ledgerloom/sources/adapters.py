"""The test tables in the shapes of the raw and star tables.

The test tables have no faults of their own. The ``loose_*`` and ``faulty_*``
frames keep every row and damage some fields, chosen by key, so that both
engines of a comparison see the same damage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.operators.joins import lookup_join
from ledgerloom.sources.schemas import PRICE, UNITS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    joined = lookup_join(
        rows, nations.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"
    )
    parts = F.split("c_name", "#")
    return joined.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        parts[0].alias("first_name"),
        parts[1].alias("last_name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias(
            "email"
        ),
        F.lit(None).cast("string").alias("phone"),
        F.col("n_name").alias("country"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(PRICE).alias("price"),
        F.lit("USD").alias("currency"),
        F.col("p_size").cast(UNITS).alias("stock_quantity"),
    )


def faulty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products, some without a price, some far cheaper or dearer."""
    price = F.col("p_retailprice").cast(PRICE)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(_every("p_partkey", 13), F.lit(None))
        .when(_every("p_partkey", 103), (price * 50).cast(PRICE))
        .when(_every("p_partkey", 7), (price - 850).cast(PRICE))
        .when(_every("p_partkey", 5), (price - 899).cast(PRICE))
        .otherwise(price)
        .alias("price"),
        F.lit("USD").alias("currency"),
        F.col("p_size").cast(UNITS).alias("stock_quantity"),
    )


def loose_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with blanks around the texts."""
    pad = F.lit("  ")
    return customers(spark, sf_dir).select(
        *[
            F.concat(pad, F.col(c), F.lit(" ")).alias(c)
            for c in ("customer_id", "first_name", "last_name", "email", "phone", "country")
        ]
    )


def loose_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as text, some numbers unreadable."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias("product_id"),
        F.concat(F.col("p_name"), F.lit("  ")).alias("product_name"),
        F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")).alias("category"),
        F.when(_every("p_partkey", 11), F.lit("n/a"))
        .when(_every("p_partkey", 17), F.lit("99999999999.99"))
        .otherwise(F.col("p_retailprice").cast(PRICE).cast("string"))
        .alias("price"),
        F.lit(" USD").alias("currency"),
        F.when(_every("p_partkey", 19), F.lit("many"))
        .otherwise(F.col("p_size").cast("string"))
        .alias("stock_quantity"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without products; the amount under both names the marts use."""
    amount = F.col("o_totalprice").cast(PRICE)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        amount.alias("order_amount"),
        amount.alias("total_amount"),
    )


def header_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in three layouts, every fourth unreadable."""
    return table(spark, sf_dir, "orders").select(
        date_text(F.col("o_orderkey"), F.col("o_orderdate").cast("date")).alias("order_date")
    )


def iso_header_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").cast("string").alias("order_date")
    )


def date_text(key: Column, day: Column) -> Column:
    return (
        F.when(key % 4 == 0, day.cast("string"))
        .when(key % 4 == 1, F.date_format(day, "yyyy/MM/dd"))
        .when(key % 4 == 2, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.lit("unknown"))
    )


def product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sold quantity per line, without the order columns."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast(UNITS).alias("quantity"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order: one product each."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("pk"),
        F.col("l_quantity").cast(UNITS).alias("q"),
        F.col("l_extendedprice").cast(PRICE).alias("amt"),
    )
    heads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("ck"),
        F.col("o_orderdate").cast("date").alias("od"),
    )
    return lookup_join(lines, heads, "k", "inner")


def _line_id() -> Column:
    return F.concat(F.col("k").cast("string"), F.lit("-"), F.col("ln").cast("string"))


def loose_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as text with blanks, lost keys and unreadable numbers."""
    return _lines(spark, sf_dir).select(
        F.when(~_every("k", 101), F.concat(F.lit(" "), _line_id(), F.lit(" "))).alias("order_id"),
        F.when(~_every("k", 97), F.concat(F.lit(" "), F.col("ck").cast("string"))).alias(
            "customer_id"
        ),
        F.when(~_every("k", 83), F.concat(F.col("pk").cast("string"), F.lit(" "))).alias(
            "product_id"
        ),
        date_text(F.col("k"), F.col("od")).alias("order_date"),
        F.when(_every("k", 79), F.lit("n/a"))
        .when(_every("k", 73), F.concat(F.lit("-"), F.col("q").cast("string")))
        .otherwise(F.col("q").cast("string"))
        .alias("quantity"),
        F.when(_every("k", 71), F.lit("free"))
        .otherwise(F.col("amt").cast("string"))
        .alias("total_amount"),
        F.lit(" USD ").alias("currency"),
    )


def _loud_quantity(key: str, quantity: Column) -> Column:
    """Some quantities a thousand times too large."""
    return F.when(_every(key, 199), (quantity * 1000).cast(UNITS)).otherwise(quantity)


def order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of ``faulty_orders``, which need no join."""
    quantity = F.col("l_quantity").cast(UNITS)
    return table(spark, sf_dir, "lineitem").select(
        _loud_quantity("l_orderkey", quantity).alias("quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("total_amount"),
    )


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed order lines with lost and unknown keys and some huge quantities."""
    return _lines(spark, sf_dir).select(
        _line_id().alias("order_id"),
        F.when(_every("k", 97), F.lit(None))
        .when(_every("k", 89), F.concat(F.lit("gone-"), F.col("ck").cast("string")))
        .otherwise(F.col("ck").cast("string"))
        .alias("customer_id"),
        F.when(_every("k", 83), F.concat(F.lit("gone-"), F.col("pk").cast("string")))
        .otherwise(F.col("pk").cast("string"))
        .alias("product_id"),
        F.col("od").cast("string").alias("order_date"),
        _loud_quantity("k", F.col("q")).alias("quantity"),
        F.col("amt").alias("total_amount"),
        F.lit("USD").alias("currency"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw clicks, all text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("click_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit(None).cast("string").alias("product_id"),
        F.concat(F.lit("/"), F.col("event_type")).alias("page_url"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("click_timestamp"),
        F.lit(None).cast("string").alias("device_type"),
    )


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ticket for every customer, all text; some categories hold a line break."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("T"), key.cast("string")).alias("ticket_id"),
        key.cast("string").alias("customer_id"),
        F.when(key % 6 == 0, F.concat("c_mktsegment", F.lit(",\n\"urgent\""))).otherwise(F.col("c_mktsegment")).alias("issue_category"),
        F.concat(F.lit("2024-03-"), F.lpad((key % 28 + 1).cast("string"), 2, "0")).alias("created_at"),
        F.when(key % 3 == 0, "open").otherwise("closed").alias("status"),
        F.when(key % 3 != 0, (key % 72).cast("string")).alias("resolution_time_hours"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder."""
    schema = table(spark, sf_dir, "events").schema
    # A glob, since a stream refuses a path that is a single plain file.
    path = f"{sf_dir.rstrip('/')}/{{events}}.parquet"
    return spark.readStream.schema(schema).parquet(path)


def click_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of JSON messages, some broken, without id, late in the day or too long."""
    key = F.col("event_id")
    body = F.to_json(
        F.struct(
            F.when(key % 13 != 0, key.cast("string")).alias("click_id"),
            F.col("user_id").cast("string").alias("customer_id"),
            page_of(key, F.col("event_type"), key % 19 == 0).alias("page_url"),
            F.when(key % 17 == 0, F.lit("yesterday")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("click_timestamp"),
            device_of(key).alias("device_type"),
        )
    )
    return event_stream(spark, sf_dir).select(
        F.when(key % 11 == 0, F.substring(body, 1, 20)).otherwise(body).cast("binary").alias("value"),
        F.lit("clicks").alias("topic"),
        (key % 4).cast("int").alias("partition"),
        key.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def page_of(key: Column, kind: Column, long: Column | bool = False) -> Column:
    page = F.concat(F.lit("/"), kind, F.lit("/"), (key % 7).cast("string"))
    return F.when(F.lit(long) if isinstance(long, bool) else long, F.rpad(page, 600, "x")).otherwise(page)


def device_of(key: Column) -> Column:
    """A device for four of five clicks."""
    return F.when(key % 5 == 1, "tablet").when(key % 5 == 2, "phone").when(key % 5 > 2, "desktop")
