"""The registered queries: the library's functions over the whole test tables.

Money leaves as a double of two places, so that both engines print it alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerloom.functions import dates, labels
from ledgerloom.operators import checks, dedupe, segments
from ledgerloom.operators.joins import lookup_join, missing_lookup, orphan_rows
from ledgerloom.operators.joins import orphan_counts as orphan_counts_of
from ledgerloom.operators.outliers import impute_with_median
from ledgerloom.operators.quantiles import exact_quantiles
from ledgerloom.operators.reconcile import reconcile_layers
from ledgerloom.plans import dashboard, marts, quality, star
from ledgerloom.plans.warehouse import build_warehouse
from ledgerloom.session import shared_folder, stored
from ledgerloom.sources import adapters, csv_files, history, store
from ledgerloom.sources.schemas import RAW_TABLES
from ledgerloom.streaming import clicks as streams
from ledgerloom.streaming.issues import alert_issues, drain_to_issues
from ledgerloom.streaming.landing import land_messages
from ledgerloom.streaming.sessions import session_paths

AS_OF = date(2025, 9, 5)
RUN_ID = "run-1"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def money(name: str, alias: str | None = None) -> Column:
    return F.round(F.col(name).cast("double"), 2).alias(alias or name)


def as_double(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("double") for n in names}


def _landed_orders(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Faulty orders as a stored raw table, for work that reads them repeatedly."""
    orders = adapters.faulty_orders(spark, d)
    return stored(orders.select(*columns) if columns else orders, "raw-orders")


# --- marts -----------------------------------------------------------------


@query
def sales_anomalies(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.sales_anomalies(adapters.order_headers(spark, d))
    return rows.select(
        "order_day",
        money("daily_revenue"),
        money("rolling_avg_7d"),
        money("rolling_std_7d"),
        "status",
    )


@query
def sales_anomalies_text(spark: SparkSession, d: str) -> DataFrame:
    """Text dates in three layouts, every fourth unreadable."""
    text = adapters.date_text(F.col("order_id").cast("long"), F.col("order_date"))
    rows = marts.sales_anomalies(adapters.order_headers(spark, d).withColumn("order_date", text))
    return rows.select("order_day", money("daily_revenue"), money("rolling_avg_7d"), "status")


@query
def top_customers(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.top_customers(adapters.order_headers(spark, d))
    return rows.select("customer_id", money("total_revenue"))


@query
def top_customers_by_lines(spark: SparkSession, d: str) -> DataFrame:
    """Amounts from quantity and price; lines with unknown products have none."""
    fact = star.enriched_orders(
        adapters.faulty_orders(spark, d),
        adapters.faulty_products(spark, d),
    )
    return marts.top_customers(fact).select("customer_id", money("total_revenue"))


@query
def top_customers_named(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.top_customers_named(
        adapters.order_headers(spark, d), adapters.customers(spark, d)
    )
    return rows.select("customer_id", "customer_name", money("total_revenue"), "total_orders")


@query
def customer_spend(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.customer_spend(adapters.order_headers(spark, d), adapters.customers(spark, d))
    return rows.select("customer_name", money("total_spent"), "orders_cnt")


@query
def product_category_sales(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.category_revenue(adapters.product_sales(spark, d), adapters.products(spark, d))
    return rows.select("category", money("category_revenue"))


@query
def revenue_by_month(spark: SparkSession, d: str) -> DataFrame:
    orders = adapters.order_headers(spark, d)
    days = star.calendar_dates(adapters.iso_header_dates(spark, d), AS_OF)
    rows = marts.revenue_by_month(orders, days)
    return rows.select("year", "month_num", "month_name", money("revenue"))


def _ranked(rows: DataFrame, *columns: str) -> DataFrame:
    """The place at which a reader meets each row; marts are small, so one task numbers them."""
    order = Window.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
    return marts.in_reading_order(rows, *columns).withColumn("place", F.row_number().over(order))


@query
def categories_in_order(spark: SparkSession, d: str) -> DataFrame:
    grouped = marts.category_revenue(adapters.product_sales(spark, d), adapters.products(spark, d))
    return _ranked(grouped, "category").select("place", "category", money("category_revenue"))


@query
def months_in_order(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(revenue_by_month(spark, d), "year", "month_num").select("place", "year", "month_num", "revenue")


@query
def new_customers_daily(spark: SparkSession, d: str) -> DataFrame:
    """The first order day stands for the sign-up."""
    firsts = (
        adapters.order_headers(spark, d)
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("signup_date"))
    )
    return marts.new_customers_daily(firsts)


@query
def customers_by_country(spark: SparkSession, d: str) -> DataFrame:
    return marts.customers_by_country(adapters.customers(spark, d))


@query
def full_names(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh customer has no last name, so no full name either."""
    rows = adapters.customers(spark, d).withColumn(
        "last_name", F.when(F.col("customer_id").cast("long") % 7 != 0, F.col("last_name"))
    )
    return marts.with_full_name(rows).select("customer_id", "first_name", "last_name", "full_name")


@query
def sales_forecast(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.sales_trend(adapters.order_headers(spark, d))
    return rows.select("forecast_day", money("expected_revenue"))


# --- star schema -----------------------------------------------------------


@query
def dim_date_calendar(spark: SparkSession, d: str) -> DataFrame:
    return star.calendar_dates(adapters.header_dates(spark, d), AS_OF)


@query
def dim_date_observed(spark: SparkSession, d: str) -> DataFrame:
    return star.observed_dates(adapters.iso_header_dates(spark, d))


@query
def dim_customers_conformed(spark: SparkSession, d: str) -> DataFrame:
    return star.conformed_customers(adapters.loose_customers(spark, d))


@query
def dim_products_conformed(spark: SparkSession, d: str) -> DataFrame:
    rows = star.conformed_products(adapters.loose_products(spark, d))
    return rows.withColumns(as_double("price", "stock_quantity"))


@query
def fact_orders_conformed(spark: SparkSession, d: str) -> DataFrame:
    raw = stored(adapters.loose_orders(spark, d), "loose-orders")
    rows = star.conformed_orders(raw)
    return rows.withColumns(as_double("quantity", "total_amount"))


@query
def orders_enriched(spark: SparkSession, d: str) -> DataFrame:
    fact = star.typed_fact(
        star.staged_fact(
            star.staged_orders(
                star.enriched_orders(
                    adapters.faulty_orders(spark, d), adapters.faulty_products(spark, d)
                )
            )
        )
    )
    return fact.withColumns(as_double("quantity", "price", "order_amount"))


@query
def orders_enriched_salted(spark: SparkSession, d: str) -> DataFrame:
    """The join that a product table past the broadcast threshold gets, hot keys split."""
    products = adapters.faulty_products(spark, d).select("product_id", "price")
    rows = lookup_join(_landed_orders(spark, d), products, "product_id", "left", shuffled=True)
    return rows.select(
        "order_id",
        "customer_id",
        "product_id",
        F.col("quantity").cast("double").alias("quantity"),
        F.col("price").cast("double").alias("price"),
        (F.col("quantity") * F.col("price")).cast("double").alias("order_amount"),
    )


@query
def product_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = star.product_summary(adapters.faulty_products(spark, d))
    return rows.withColumns(as_double("price", "stock_quantity"))


# --- checks ----------------------------------------------------------------


@query
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    return checks.row_counts(
        {
            "raw_customers": adapters.table(spark, d, "customer"),
            "raw_products": adapters.table(spark, d, "part"),
            "raw_orders": adapters.table(spark, d, "lineitem"),
            "raw_clicks": adapters.table(spark, d, "events"),
        }
    )


@query
def missing_keys(spark: SparkSession, d: str) -> DataFrame:
    return checks.missing_counts(
        adapters.loose_orders(spark, d), ["order_id", "customer_id", "product_id"]
    )


@query
def orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = orphan_counts_of(
        adapters.faulty_orders(spark, d),
        {"customer_id": adapters.customers(spark, d), "product_id": adapters.products(spark, d)},
    )
    table = F.when(F.col("missing") == "customer_id", "customers").otherwise("products")
    return rows.select(table.alias("missing"), "n")


@query
def orphan_orders(spark: SparkSession, d: str) -> DataFrame:
    rows = orphan_rows(
        adapters.faulty_orders(spark, d), adapters.customers(spark, d), "customer_id"
    )
    return rows.select("order_id", "customer_id", "product_id")


@query
def product_profile(spark: SparkSession, d: str) -> DataFrame:
    rows = checks.numeric_profile(
        adapters.faulty_products(spark, d),
        {"price": "price"},
        distinct={"product_id": "unique_products"},
    )
    return rows.select(
        F.col("total_rows").alias("total_products"),
        "unique_products",
        money("min_price"),
        money("max_price"),
        money("avg_price"),
    )


@query
def numeric_profile(spark: SparkSession, d: str) -> DataFrame:
    rows = checks.numeric_profile(
        adapters.order_measures(spark, d), {"quantity": "qty", "total_amount": "amount"}
    )
    return rows.select(
        F.col("total_rows").alias("total_orders"),
        *[money(f"{f}_{n}") for n in ("qty", "amount") for f in ("min", "max", "avg")],
    )


@query
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return checks.repeated_keys(
        adapters.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def not_null_failures(spark: SparkSession, d: str) -> DataFrame:
    rows = checks.null_rows(adapters.faulty_orders(spark, d), "customer_id")
    return rows.select("order_id", "product_id", "order_date")


@query
def null_default_fill(spark: SparkSession, d: str) -> DataFrame:
    rows = checks.fill_defaults(
        adapters.faulty_orders(spark, d).select("order_id", "customer_id"),
        {"customer_id": "unknown"},
    )
    return rows.groupBy("customer_id").agg(F.count("*").alias("orders"))


@query
def deduped_customers(spark: SparkSession, d: str) -> DataFrame:
    """Every customer arrives twice; the later copy has another country."""
    rows = adapters.customers(spark, d)
    copies = rows.withColumn("country", F.lit("LATER"))
    arrived = rows.withColumn("ingest_order", F.lit(1)).unionByName(
        copies.withColumn("ingest_order", F.lit(2))
    )
    unique = dedupe.first_per_key(arrived, ["customer_id"], "ingest_order")
    return unique.select("customer_id", "first_name", "last_name", "country")


# --- quality run -----------------------------------------------------------


def _events(spark: SparkSession, d: str) -> DataFrame:
    return adapters.table(spark, d, "events").select("event_id", "value")


@query
def outlier_flags(spark: SparkSession, d: str) -> DataFrame:
    flagged = quality.flag_outliers(_events(spark, d), ["value"])
    return flagged.where("outlier_value").select("event_id", "value")


@query
def outlier_imputed(spark: SparkSession, d: str) -> DataFrame:
    flagged = quality.flag_outliers(_events(spark, d), ["value"])
    filled = impute_with_median(flagged, "value", "outlier_value", ["event_id"])
    return filled.select("event_id", F.round("value", 6).alias("value"))


@query
def outlier_imputed_stepwise(spark: SparkSession, d: str) -> DataFrame:
    """Amounts of both signs leave a gap in the middle, so the fills differ by row."""
    rows = adapters.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        _two_sided(F.col("o_orderkey"), F.col("o_totalprice")).alias("value"),
    )
    flagged = quality.flag_outliers(rows, ["value"])
    filled = impute_with_median(flagged, "value", "outlier_value", ["event_id"])
    return filled.select("event_id", F.round("value", 6).alias("value"))


def _two_sided(key: Column, price: Column) -> Column:
    """Even keys above zero, odd ones below; a few of each sign far out."""
    side = F.when(key % 2 == 0, 1.0).otherwise(-1.0)
    far = F.when((key % 400).isin(0, 1, 5), 1000.0).otherwise(1.0)
    return side * (price + 4000.0) * far / 3.0


def _flagged(spark: SparkSession, d: str, null_policy: str) -> DataFrame:
    products = adapters.faulty_products(spark, d)
    fact = star.staged_fact(
        star.staged_orders(star.enriched_orders(adapters.faulty_orders(spark, d), products))
    ).drop("order_amount", "order_date")
    # The statistics and the flags both read the fact, so the joins run once.
    return quality.flag_fact(
        stored(fact, "fact"), adapters.customers(spark, d), products, null_policy
    )


@query
def issue_log(spark: SparkSession, d: str) -> DataFrame:
    """Missing prices leave the price column without outliers."""
    return quality.issue_log(_flagged(spark, d, "propagate"), RUN_ID)


@query
def issue_log_known_prices(spark: SparkSession, d: str) -> DataFrame:
    return quality.issue_log(_flagged(spark, d, "omit"), RUN_ID)


@query
def orphan_imputed(spark: SparkSession, d: str) -> DataFrame:
    orders = _landed_orders(spark, d, "order_id", "customer_id", "product_id")
    rows = missing_lookup(
        orders, adapters.customers(spark, d), "customer_id", "lost_customer"
    )
    # As for a product table past the broadcast threshold.
    rows = missing_lookup(
        rows, adapters.products(spark, d), "product_id", "lost_product", large=True
    )
    return rows.select(
        "order_id",
        F.when(F.col("lost_customer"), quality.UNKNOWN_KEY)
        .otherwise(F.col("customer_id"))
        .alias("customer_id"),
        F.when(F.col("lost_product"), quality.UNKNOWN_KEY)
        .otherwise(F.col("product_id"))
        .alias("product_id"),
    )


@query
def high_value_orders(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.high_value_orders(adapters.order_headers(spark, d).drop("total_amount"))
    return rows.withColumns(as_double("order_amount"))


@query
def high_value_orders_tied(spark: SparkSession, d: str) -> DataFrame:
    """Amounts in steps of 0.29, so that the limit is the value of many orders."""
    tied = (F.floor(F.col("order_amount") / 50_000) * F.lit("0.29").cast("decimal(4,2)")).cast("decimal(12,2)")
    orders = adapters.order_headers(spark, d).drop("total_amount")
    rows = quality.high_value_orders(stored(orders.withColumn("order_amount", tied), "tied"))
    return rows.withColumns(as_double("order_amount"))


@query
def quantile_profile(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles by the bracket search, joined to rows counted against them."""
    orders = adapters.order_headers(spark, d)
    wanted = [1 / 3, 0.5, 2 / 3, 0.9]
    found = exact_quantiles(orders, "order_amount", wanted, bracketed=True)
    amount = F.col("order_amount").cast("double")
    parts = []
    for p, q in zip(wanted, found):
        name = f"p{round(p * 100)}"
        parts.append(F.round(F.lit(q.value), 4).alias(f"{name}_value"))
        parts.append(F.count_if(amount <= F.lit(q.value)).alias(f"{name}_rows"))
    return orders.agg(F.count("*").alias("n"), *parts)


# --- dashboard -------------------------------------------------------------


@query
def customer_segments(spark: SparkSession, d: str) -> DataFrame:
    rows = dashboard.customer_segments(adapters.order_headers(spark, d))
    return rows.select("customer_id", money("total_revenue"), "segment", "segment_rank")


@query
def all_customer_segments(spark: SparkSession, d: str) -> DataFrame:
    """The tiers over every customer, not only the top ten."""
    revenue = (
        adapters.order_headers(spark, d)
        .groupBy("customer_id")
        .agg(F.sum("order_amount").alias("total_revenue"))
    )
    rows = segments.tercile_segments(stored(revenue, "revenue"), "total_revenue")
    return rows.select("customer_id", money("total_revenue"), "segment", "segment_rank")


@query
def segment_revenue(spark: SparkSession, d: str) -> DataFrame:
    rows = dashboard.segment_revenue(adapters.order_headers(spark, d))
    return rows.select("segment", "segment_rank", "members", money("total_revenue"))


@query
def category_share(spark: SparkSession, d: str) -> DataFrame:
    grouped = marts.category_revenue(adapters.product_sales(spark, d), adapters.products(spark, d))
    rows = segments.with_share(grouped, "category_revenue")
    return rows.select(
        "category", money("category_revenue"), F.round("share", 6).alias("share")
    )


# --- files, tables, models -------------------------------------------------


def _dirty_csv(spark: SparkSession, d: str) -> str:
    """Products as CSV files with blanks, NULL words, bad numbers and header lines."""
    names = [f.name for f in RAW_TABLES["raw_products"]]
    rows = adapters.loose_products(spark, d).withColumn(
        "currency",
        F.when(F.col("stock_quantity") == "7", "NULL")
        .when(F.col("stock_quantity") == "8", "null")
        .when(F.col("stock_quantity") == "9", "a currency name that is too long")
        .otherwise(F.concat(F.lit("US,"), F.lit("D"))),
    )
    # Where a price is unreadable, every second row repeats the header line.
    echo = (F.col("price") == "n/a") & (F.trim("product_id").cast("long") % 2 == 0)
    rows = rows.select(
        *[F.when(echo, F.lit(n.upper())).otherwise(F.col(n)).alias(n) for n in names]
    )
    path = shared_folder(spark, "products-csv")
    csv_files.write_csv(rows, path)
    return path


@query
def csv_ingest(spark: SparkSession, d: str) -> DataFrame:
    path = _dirty_csv(spark, d)
    good, bad = csv_files.land_csv(
        spark, path, "raw_products", shared_folder(spark, "products")
    )
    names = [f.name for f in RAW_TABLES["raw_products"]]
    kept = good.select(*[F.col(n).cast("string").alias(n) for n in names]).withColumn(
        "reject_reason", F.lit(None).cast("string")
    )
    return kept.unionByName(bad.select(*names, "reject_reason"))


@query
def csv_multiline(spark: SparkSession, d: str) -> DataFrame:
    """Product names with line breaks inside quotes stay in one row."""
    broken = F.concat(F.col("product_name"), F.lit("\n\"second\" line, more"))
    rows = adapters.products(spark, d).withColumn(
        "product_name", F.when(F.col("product_id").cast("long") % 3 == 0, broken).otherwise(F.col("product_name"))
    )
    path = shared_folder(spark, "broken-lines-csv")
    csv_files.write_csv(rows.select(*[f.name for f in RAW_TABLES["raw_products"]]), path)
    good, bad = csv_files.load_csv(spark, path, "raw_products")
    kept = good.select("product_id", "product_name", F.lit(False).alias("rejected"))
    return kept.unionByName(bad.select("product_id", "product_name", F.lit(True).alias("rejected")))


@contextmanager
def _ranges_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Scan ranges of ``size``, so that files of the test tables have many."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, size)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@query
def csv_multiline_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Files of orders, each read in many ranges; notes hold line breaks, quotes and commas."""
    key = F.col("o_orderkey")
    note = F.concat("o_orderpriority", F.lit('\n"'), F.repeat(F.lit('a, ""b\n'), (key % 40).cast("int")), F.lit('"'))
    rows = adapters.table(spark, d, "orders").select(
        key.cast("string").alias("ticket_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(key % 9 == 0, F.lit("x,\n,y")).otherwise(F.col("o_orderstatus")).alias("issue_category"),
        F.when(key % 4 == 0, note).otherwise(F.col("o_orderpriority")).alias("created_at"),
        F.lit("open").alias("status"),
        F.when(key % 7 == 0, F.lit("NULL")).otherwise((key % 100).cast("string")).alias("resolution_time_hours"),
    )
    path = shared_folder(spark, "range-csv")
    csv_files.write_csv(rows, path)
    with _ranges_of(spark, "64k"):
        read = csv_files.read_csv_text(spark, path, "raw_support_tickets", "ranges")
    read = stored(read, "tickets")
    return read.select(
        "ticket_id", "customer_id", "issue_category", F.length("created_at").alias("note_length"), F.md5("created_at").alias("note_md5"), "resolution_time_hours"
    )


@query
def csv_reload(spark: SparkSession, d: str) -> DataFrame:
    """Five tables, each loaded three times from overlapping sets of files."""
    db = _new_database(spark, "loads")
    raw = {
        "raw_customers": adapters.customers(spark, d),
        "raw_products": adapters.products(spark, d),
        "raw_orders": adapters.faulty_orders(spark, d),
        "raw_clicks": adapters.clicks(spark, d),
        "raw_support_tickets": adapters.support_tickets(spark, d),
    }
    out = []
    for name, rows in raw.items():
        base = shared_folder(spark, name)
        names = [f.name for f in RAW_TABLES[name]]
        part = F.pmod(F.xxhash64(names[0]), F.lit(3)).cast("int")
        rows.select(*names, part.alias("set")).write.partitionBy("set").option("header", "true").option("escape", '"').csv(base)
        sets = [[f"{base}/set={i}" for i in chosen] for chosen in ((0, 1), (1, 2), (0, 1, 2))]
        loads = [history.load_new_files(spark, paths, name, db, f"load-{i}") for i, paths in enumerate(sets)]
        out.append(
            spark.table(f"{db}.{name}").agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("total_rows"),
                F.count_distinct(names[0]).alias("keys"),
                F.lit(sum(x.accepted + x.rejected for x in loads)).cast("long").alias("rows_read"),
                F.lit(loads[2].loaded).alias("files_in_last_load"),
            )
        )
    rows = out[0]
    for one in out[1:]:
        rows = rows.unionByName(one)
    return rows


@query
def customer_transform(spark: SparkSession, d: str) -> DataFrame:
    """Extract to CSV, read typed, add the full name, write, read back."""
    first = shared_folder(spark, "customers-csv")
    csv_files.write_csv(adapters.customers(spark, d), first)
    loaded, _ = csv_files.load_csv(spark, first, "raw_customers")
    named = marts.with_full_name(loaded.drop("ingest_order"))
    second = shared_folder(spark, "customers-transformed-csv")
    csv_files.write_csv(named, second)
    return spark.read.schema(named.schema).options(**csv_files.CSV_OPTIONS).csv(second)


def _new_database(spark: SparkSession, purpose: str) -> str:
    folder = shared_folder(spark, purpose)
    name = folder.rsplit("/", 2)[1].replace("-", "_")
    store.open_database(spark, name, folder)
    return name


@query
def store_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Replace, create, append twice under one run, add new keys, snapshot."""
    db = _new_database(spark, "tables")
    orders = adapters.order_headers(spark, d).select("order_id", "customer_id", "order_amount")
    store.replace_table(orders, db, "orders")
    # The second replace reads the table it replaces.
    known = spark.table(f"{db}.orders")
    store.replace_table(
        known.withColumn("order_amount", F.col("order_amount") * 2), db, "orders"
    )
    store.create_table(orders.select("order_id", "order_amount"), db, "amounts")
    store.snapshot_table(spark, db, "orders")
    issues = orders.where(F.col("order_amount") > 400_000).select("order_id")
    store.append_run(issues, db, "issues", "run-1")
    store.append_run(issues, db, "issues", "run-1")
    store.append_run(issues, db, "issues", "run-2")
    early = orders.where(F.col("order_amount") <= 100_000)
    store.replace_table(early, db, "loaded")
    # The load holds every order twice, and comes twice.
    store.append_new_keys(orders.unionByName(orders), db, "loaded", ["order_id"])
    store.append_new_keys(orders.unionByName(orders), db, "loaded", ["order_id"])
    names = ("orders", "amounts", "orders_backup", "issues", "loaded")
    parts = [
        spark.table(f"{db}.{name}").agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.count_distinct("order_id").alias("n_orders"),
            (
                F.sum("order_amount") if name != "issues" else F.lit(None).cast("double")
            ).cast("double").alias("amount"),
        )
        for name in names
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def incremental_load(spark: SparkSession, d: str) -> DataFrame:
    """Orders in loads by key range; the last one repeats some keys of the first and adds new ones."""
    db = _new_database(spark, "increments")
    orders = stored(adapters.order_headers(spark, d).select(F.col("order_id").cast("long").alias("order_id"), "customer_id", "order_amount"), "orders")
    last = orders.agg(F.max("order_id")).first()[0]
    cuts = [0, last // 4, last // 2, 3 * last // 4, last + 1]
    for low, high in zip(cuts[:3], cuts[1:4]):
        store.append_new_keys(orders.where(F.col("order_id").between(low, high - 1)), db, "orders", ["order_id"])
    again = orders.where((F.col("order_id") < cuts[1] // 2) | (F.col("order_id") >= cuts[3]))
    again = again.withColumn("order_amount", F.col("order_amount") + 1).select("order_id", "customer_id", F.col("order_amount").cast("decimal(10,2)").alias("order_amount"))
    rows = store.append_new_keys(again, db, "orders", ["order_id"])
    return rows.select("order_id", "customer_id", F.col("order_amount").cast("double").alias("order_amount"))


@query
def clone_and_vacuum(spark: SparkSession, d: str) -> DataFrame:
    """A clone, a change of its source, and the folders that are left."""
    db = _new_database(spark, "clones")
    orders = adapters.order_headers(spark, d).select("order_id", "order_amount")
    store.replace_table(orders, db, "orders")
    store.clone_table(spark, db, "orders", "orders_backup")
    doubled = spark.table(f"{db}.orders").withColumn("order_amount", (F.col("order_amount") * 2).cast("decimal(10,2)"))
    store.replace_table(doubled, db, "orders")
    store.replace_table(doubled, db, "orders")
    more = orders.withColumn("order_id", F.concat(F.lit("n"), F.col("order_id")))
    store.append_new_keys(more, db, "orders_backup", ["order_id"])
    store.clone_table(spark, db, "orders_backup", "orders_copy")
    removed = len(store.vacuum(spark, db, older_than_hours=0.0))
    parts = [
        spark.table(f"{db}.{name}").agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.sum("order_amount").cast("double").alias("amount"),
            F.lit(removed).cast("long").alias("folders_removed"),
        )
        for name in ("orders", "orders_backup", "orders_copy")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def lasting_views(spark: SparkSession, d: str) -> DataFrame:
    """Views and passed-on tables of a whole build, read by another session of the catalog."""
    heads = adapters.order_headers(spark, d)
    raw = {
        "raw_customers": adapters.customers(spark, d),
        "raw_products": adapters.faulty_products(spark, d),
        "raw_orders": _landed_orders(spark, d),
        "raw_clicks": adapters.clicks(spark, d),
        "raw_support_tickets": adapters.support_tickets(spark, d),
        "signups": heads.groupBy("customer_id").agg(F.min("order_date").alias("signup_date")),
    }
    db = _new_database(spark, "served")
    build_warehouse(raw, db, RUN_ID, AS_OF)
    other = spark.newSession()
    amounts = {
        "fact_orders": "order_amount", "vw_top_customers": "total_revenue", "vw_sales_anomalies": "daily_revenue",
        "vw_orders": "order_amount", "vw_customers": None, "vw_products": None, "staging_clicks": None, "staging_support_tickets": None,
        "new_customers_daily": "new_customers", "orders_enriched_backup": "order_amount", "dim_customers_backup": None, "dim_products_backup": None,
    }
    rows = [
        other.table(f"{db}.{name}").agg(
            F.lit(name).alias("relation"),
            F.count("*").alias("n_rows"),
            money_of(F.sum(c) if c else F.lit(None)).alias("amount"),
        )
        for name, c in amounts.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def money_of(amount: Column) -> Column:
    return F.round(amount.cast("double"), 2)


@query
def layer_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """Raw, staging, fact and clean fact with planted differences at each step."""
    names = ("order_id", "customer_id", "product_id", "quantity", "order_date")
    raw = stored(adapters.faulty_orders(spark, d).select(*names), "raw")
    line = F.split("order_id", "-")[0].cast("long")
    staging = raw.where(line % 211 != 0)
    dated = staging.withColumn("order_date", F.to_date("order_date"))
    fact = dated.withColumn("quantity", F.when(line % 307 == 0, F.col("quantity") + 1).otherwise(F.col("quantity")).cast("decimal(18,0)"))
    copies = fact.where(line % 401 == 0).withColumn("order_id", F.concat(F.lit("new-"), F.col("order_id")))
    clean = fact.withColumn("customer_id", F.coalesce("customer_id", F.lit("-1"))).unionByName(copies)
    layers = {"raw": raw, "staging": staging, "fact": fact, "clean": clean}
    rows = reconcile_layers(layers, ["order_id"], list(names[1:]))
    return rows.withColumn("columns", F.coalesce(F.array_join("columns", ","), F.lit("")))


@query
def views_and_models(spark: SparkSession, d: str) -> DataFrame:
    """A starter model over inline rows and customers, and a model on that model."""
    db = _new_database(spark, "models")
    inline = spark.createDataFrame([(1,), (None,)], "id long")
    keys = adapters.table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    first = store.materialize(inline.unionByName(keys), "my_first_model", "table", db)
    second = store.materialize(first.where(F.col("id") == 1), "my_second_model")
    listed = store.list_tables(spark, db).where(~F.col("is_temporary"))
    parts = []
    for name, df in (("my_first_model", first), ("my_second_model", second)):
        nulls = checks.null_rows(df, "id").agg(F.count("*")).scalar()
        repeats = checks.repeated_keys(df, ["id"]).agg(F.count("*")).scalar()
        tables = listed.where(F.col("table_name") == name).agg(F.count("*")).scalar()
        parts.append(
            df.agg(F.count("*").alias("n_rows")).select(
                F.lit(name).alias("model"),
                "n_rows",
                nulls.alias("null_ids"),
                repeats.alias("repeated_ids"),
                tables.alias("stored_tables"),
            )
        )
    return parts[0].unionByName(parts[1])


@query
def catalog_listing(spark: SparkSession, d: str) -> DataFrame:
    """Columns of a stored table, a lasting view and a view of the session, as the catalog describes them."""
    db = _new_database(spark, "listing")
    store.replace_table(adapters.order_headers(spark, d), db, "orders")
    store.publish_views(spark, db, {
        "vw_large": "SELECT order_id, total FROM vw_orders WHERE total > 100",
        "vw_orders": "SELECT order_id, order_amount AS total FROM orders",
    })
    store.replace_view(spark.table(f"{db}.orders").select("customer_id"), "ledgerloom_listed")
    listed = store.list_relations(spark, db)
    return listed.where("kind <> 'temporary view' OR relation = 'ledgerloom_listed'")


@query
def preview_rows(spark: SparkSession, d: str) -> DataFrame:
    return store.preview(adapters.customers(spark, d), "customer_id").select(
        "customer_id", "first_name", "last_name", "country"
    )


@query
def query_to_frame(spark: SparkSession, d: str) -> DataFrame:
    """SQL text over a view."""
    store.replace_view(adapters.order_headers(spark, d), "ledgerloom_orders")
    return spark.sql(
        "SELECT customer_id, count(*) AS orders FROM ledgerloom_orders "
        "WHERE order_amount > 250000 GROUP BY customer_id"
    )


@query
def star_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """The whole build from raw tables; every stored table is counted."""
    raw = {
        "raw_customers": adapters.customers(spark, d),
        "raw_products": adapters.faulty_products(spark, d),
        "raw_orders": _landed_orders(spark, d),
    }
    built = build_warehouse(raw, _new_database(spark, "warehouse"), RUN_ID, AS_OF)
    names = (
        "dim_customers_conformed",
        "dim_products_conformed",
        "dim_date_conformed",
        "fact_orders_conformed",
        "orders_enriched",
        "dim_date",
        "fact_orders",
        "fact_orders_clean",
        "data_quality_issues",
    )
    return checks.row_counts({name: built[name] for name in names})


@query
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    """One row per order with each scalar function of the library."""
    orders = adapters.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderdate").alias("ts"),
        "o_orderpriority",
        "o_totalprice",
    )
    text = adapters.date_text(F.col("k"), F.col("day"))
    number = F.when(F.col("k") % 3 == 0, F.lit("x")).otherwise(
        F.col("o_totalprice").cast("decimal(10,2)").cast("string")
    )
    rows = orders.withColumn("date_text", text).withColumn("number_text", number)
    return rows.select(
        "k",
        F.trim(F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))).alias("trimmed"),
        F.concat("o_orderpriority", F.lit(" "), "date_text").alias("joined"),
        *dates.calendar_columns(F.col("day")),
        dates.tolerant_date(F.col("date_text")).alias("tolerant"),
        dates.iso_date_or_null(F.col("date_text")).alias("iso_only"),
        dates.strict_date(F.date_format("day", "yyyy-MM-dd")).alias("strict"),
        F.col("number_text").try_cast("decimal(10,2)").cast("double").alias("as_decimal"),
        F.col("number_text").try_cast("decimal(18,0)").cast("long").alias("as_number"),
        F.date_trunc("day", F.col("ts")).cast("date").alias("day_start"),
        F.date_add("day", 30).alias("day_plus"),
        F.date_sub(F.lit(AS_OF), 365).alias("year_before"),
        F.abs(F.col("o_totalprice") - 250000.0).cast("decimal(12,2)").cast("double").alias("gap"),
        labels.price_bucket(F.col("o_totalprice") / 5000).alias("bucket"),
    )


# --- streams ---------------------------------------------------------------


def _event_clicks(spark: SparkSession, d: str) -> DataFrame:
    events = adapters.event_stream(spark, d).select(
        F.col("event_id").alias("click_id"),
        F.col("user_id").alias("customer_id"),
        "event_type",
        "ts",
        "value",
    )
    return streams.with_event_time(events, "ts")


@query
def stream_daily_clicks(spark: SparkSession, d: str) -> DataFrame:
    """Counts per day and type, the open windows included."""
    counts = streams.windowed_counts(_event_clicks(spark, d), "ts", ["event_type"])
    updates = streams.drain_batches(counts, shared_folder(spark, "daily"), mode="update")
    keys = ["window_start", "event_type"]
    rows = streams.latest_counts(updates, keys, "clicks")
    return rows.select(
        F.col("window_start").cast("date").alias("day"), "event_type", "clicks"
    )


@query
def stream_closed_days(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the days that the late bound has passed."""
    counts = streams.windowed_counts(_event_clicks(spark, d), "ts", [])
    rows = streams.drain_to_files(counts, shared_folder(spark, "closed"))
    return rows.select(F.col("window_start").cast("date").alias("day"), "clicks")


@query
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions that the late bound has passed."""
    sessions = streams.click_sessions(_event_clicks(spark, d), "ts", "customer_id")
    rows = streams.drain_to_files(sessions, shared_folder(spark, "sessions"))
    return rows.select(
        "customer_id",
        F.unix_micros("session_start").alias("start_micros"),
        F.unix_micros("session_end").alias("end_micros"),
        "clicks",
    )


@query
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every click is delivered twice and kept once."""
    source = adapters.event_stream(spark, d).select("*", F.col("_metadata.row_index").alias("row"))
    deliveries = [
        streams.with_event_time(
            source.select(
                F.col("event_id").alias("click_id"),
                F.col("user_id").alias("customer_id"),
                "event_type",
                "ts",
                "value",
                (F.col("row") * 2 + copy).alias("place"),
            ),
            "ts",
        )
        for copy in (0, 1)
    ]
    unique = streams.unique_clicks(deliveries[0].unionByName(deliveries[1]), place="place")
    rows = streams.drain_to_files(unique, shared_folder(spark, "unique"))
    return rows.select("click_id", "customer_id", "event_type", "value")


def _known_customers(spark: SparkSession, d: str) -> DataFrame:
    """Customer keys, every thirteenth one lost."""
    return adapters.table(spark, d, "customer").select(
        F.when(F.col("c_custkey") % 13 == 0, -F.col("c_custkey") - 1)
        .otherwise(F.col("c_custkey"))
        .alias("customer_id"),
        "c_name",
        "c_mktsegment",
    )


@query
def stream_alerts(spark: SparkSession, d: str) -> DataFrame:
    known = streams.reference_of(adapters.table(spark, d, "events"), "value")
    find = streams.alert_batch(
        _known_customers(spark, d), "click_id", "customer_id", "value", known
    )
    rows = streams.drain_batches(
        _event_clicks(spark, d),
        shared_folder(spark, "alerts"),
        find,
        schema="customer_id long, click_id long, value double, issue_type string",
    )
    return rows.select("click_id", "customer_id", "value", "issue_type")


@query
def stream_enriched(spark: SparkSession, d: str) -> DataFrame:
    """Live clicks joined with the batch customers."""
    rows = streams.drain_batches(
        _event_clicks(spark, d).drop("ts"),
        shared_folder(spark, "enriched"),
        streams.enrich_batch(_known_customers(spark, d), "customer_id"),
        schema=(
            "customer_id long, click_id long, event_type string, value double, "
            "c_name string, c_mktsegment string"
        ),
    )
    return rows.select("click_id", "customer_id", "event_type", "c_name", "c_mktsegment")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("event_id")
    events = adapters.event_stream(spark, d).select(
        key.alias("click_id"),
        F.col("user_id").alias("customer_id"),
        adapters.page_of(key, F.col("event_type")).alias("page_url"),
        adapters.device_of(key).alias("device_type"),
        "ts",
    )
    return streams.with_event_time(events, "ts")


@query
def stream_sessions_path(spark: SparkSession, d: str) -> DataFrame:
    """Sessions that the late bound has passed, with devices and the pages in order."""
    sessions = session_paths(_pages(spark, d), "ts", "customer_id")
    rows = streams.drain_to_files(sessions, shared_folder(spark, "session-paths"))
    return rows.select(
        "customer_id",
        F.unix_micros("session_start").alias("start_micros"),
        "clicks",
        "device",
        F.array_join("devices", ",").alias("devices"),
        F.array_join("path", " > ").alias("path"),
    )


@query
def stream_raw_clicks(spark: SparkSession, d: str) -> DataFrame:
    """Messages landed raw: rows that load and rows that do not, by arrival day."""
    good, bad = land_messages(adapters.click_messages(spark, d), shared_folder(spark, "raw-clicks"))
    columns = ("place", "click_id", "customer_id", "page_url", "click_timestamp", "device_type", "arrival_day")
    none = F.lit(None).cast("string")
    kept = good.select(*columns, none.alias("reject_reason"), none.alias("message_md5"))
    return kept.unionByName(bad.select(*columns, "reject_reason", F.md5("message").alias("message_md5")))


@query
def stream_alert_issues(spark: SparkSession, d: str) -> DataFrame:
    """Alerts of the stream next to the issues of a batch run, out of one table."""
    db = _new_database(spark, "issues")
    store.append_run(quality.issue_log(_flagged(spark, d, "propagate"), RUN_ID), db, "data_quality_issues", RUN_ID)
    known = streams.reference_of(adapters.table(spark, d, "events"), "value")
    alerts = streams.alert_batch(_known_customers(spark, d), "click_id", "customer_id", "value", known)
    drain_to_issues(
        _event_clicks(spark, d),
        lambda batch: alert_issues(alerts(batch), "click_id", "customer_id", "value"),
        db,
        "clicks",
        shared_folder(spark, "alert-checkpoint"),
    )
    measured = F.col("issue_type") == "outlier_value"
    return spark.table(f"{db}.data_quality_issues").select(
        F.substring_index("run_id", ".", 1).alias("origin"),
        "issue_type",
        "order_id",
        "column_name",
        F.when(~measured, F.col("bad_value")).alias("bad_text"),
        F.when(measured, F.col("bad_value").cast("double")).alias("bad_number"),
        "suggestion",
    )
