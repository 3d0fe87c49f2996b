"""The whole build, from raw tables to marts, as ordered function calls."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from ledgerloom.operators.checks import missing_counts, repeated_keys
from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.plans import marts, star, views
from ledgerloom.plans.quality import clean_fact, flag_fact, issue_log
from ledgerloom.sources.store import append_run, clone_table, materialize, publish_views, replace_table


def build_warehouse(
    raw: dict[str, DataFrame],
    database: str,
    run_id: str,
    as_of: date,
    enforce_keys: bool = False,
    impute: bool = True,
    marts_as: str = "table",
) -> dict[str, DataFrame]:
    """Write the tables of ``database`` and publish the marts.

    Marts are small and stored as tables, which other sessions see too;
    ``marts_as="view"`` makes them views of this session, always up to date.
    With ``impute=False`` the clean fact is the fact as staged: outliers and
    orphan keys are logged, not replaced.

    ``raw`` holds accepted raw tables. Customers and products that come with an
    ``ingest_order`` are reduced to one row per key. Only tables that are read
    again are stored; pass-through copies are lasting views of the catalog
    (``plans.views``), which other sessions read too. ``raw_clicks`` and
    ``raw_support_tickets`` are passed on to staging where they are given, and
    ``signups`` (customer_id, signup_date) make ``new_customers_daily``. Backups of
    the staged tables are clones, made before the quality run. With ``enforce_keys``
    no mart is published while a key test fails.
    """
    spark = raw["raw_orders"].sparkSession
    customers, products = (
        _one_per_key(raw[name], key)
        for name, key in (("raw_customers", "customer_id"), ("raw_products", "product_id"))
    )
    orders = raw["raw_orders"].drop("ingest_order")

    built: dict[str, DataFrame] = {}
    for name, df in {
        "dim_customers_conformed": star.conformed_customers(customers),
        "dim_products_conformed": star.conformed_products(products),
        "dim_date_conformed": star.calendar_dates(orders, as_of),
        "fact_orders_conformed": star.conformed_orders(orders),
        "orders_enriched": star.enriched_orders(orders, products),
        "product_summary": star.product_summary(products),
        "dim_customers": star.staged_customers(customers),
        "dim_products": products,
    }.items():
        built[name] = replace_table(df, database, name)

    publish_views(spark, database, views.STAGING)
    for name in views.STAGING:
        built[name] = spark.table(f"{database}.{name}")
    fact = built["fact_orders"]
    built["dim_date"] = replace_table(star.observed_dates(built["staging_orders"]), database, "dim_date")
    for name in views.BACKUPS:
        built[f"{name}_backup"] = clone_table(spark, database, name, f"{name}_backup")
    for name, (table, staged) in views.PASSED_ON.items():
        if name in raw:
            built[table] = replace_table(raw[name].drop("ingest_order"), database, table)
            publish_views(spark, database, {staged: f"SELECT * FROM {table}"})
            built[staged] = spark.table(f"{database}.{staged}")
    if "signups" in raw:
        built["new_customers_daily"] = replace_table(
            marts.new_customers_daily(raw["signups"]), database, "new_customers_daily"
        )

    # The flags are stored once; the clean fact and the issue log both read them.
    flagged = replace_table(
        flag_fact(fact, built["dim_customers"], built["dim_products"]),
        database,
        "fact_orders_flagged",
    )
    clean = clean_fact(flagged, ["order_id", "customer_id", "product_id"]) if impute else fact
    built["fact_orders_clean"] = replace_table(clean, database, "fact_orders_clean")
    issues = append_run(issue_log(flagged, run_id), database, "data_quality_issues", run_id)
    if issues is not None:
        built["data_quality_issues"] = issues

    if enforce_keys:
        dimensions = {
            "customer_id": built["dim_customers"],
            "product_id": built["dim_products"],
        }
        failed = gate(built["fact_orders_clean"], dimensions)
        if failed:
            raise ValueError(f"key tests failed: {', '.join(failed)}")

    clean = built["fact_orders_clean"]
    conformed = built["fact_orders_conformed"]
    for name, df in {
        "top_customers": marts.top_customers(clean),
        "customer_spend": marts.customer_spend(conformed, built["dim_customers_conformed"]),
        "product_category_sales": marts.category_sales(clean, built["dim_products"]),
        "anomalies": marts.sales_anomalies(clean),
        "revenue_by_month": marts.revenue_by_month(conformed, built["dim_date_conformed"]),
    }.items():
        built[name] = materialize(df, name, marts_as, database)
    publish_views(spark, database, views.READERS)
    for name in views.READERS:
        built[name] = spark.table(f"{database}.{name}")
    return built


def _one_per_key(df: DataFrame, key: str) -> DataFrame:
    if "ingest_order" not in df.columns:
        return df
    return first_per_key(df, [key], "ingest_order").drop("ingest_order")


def gate(fact: DataFrame, dimensions: dict[str, DataFrame]) -> list[str]:
    """Names of the data tests that fail: keys present and unique."""
    failed = []
    for key, dim in dimensions.items():
        if missing_counts(dim, [key]).first()[0]:
            failed.append(f"not_null:{key}")
        if not repeated_keys(dim, [key]).isEmpty():
            failed.append(f"unique:{key}")
    if missing_counts(fact, ["order_id"]).first()[0]:
        failed.append("not_null:order_id")
    if not repeated_keys(fact, ["order_id"]).isEmpty():
        failed.append("unique:order_id")
    return failed
