"""Lasting views of the warehouse: queries over its tables and over each other."""

from __future__ import annotations

STAGING = {
    "staging_orders": """
        SELECT order_id, customer_id, product_id, quantity, price, order_date,
               quantity * price AS order_amount
        FROM orders_enriched""",
    "fact_orders": """
        SELECT order_id, customer_id, product_id, quantity, price, order_amount,
               to_date(order_date, 'yyyy-MM-dd') AS order_date
        FROM staging_orders""",
}

READERS = {
    "vw_orders": "SELECT * FROM orders_enriched",
    "vw_customers": "SELECT * FROM dim_customers",
    "vw_products": "SELECT * FROM dim_products",
    # Sums per customer meet the names; orders are counted for the ten that are shown.
    "vw_top_customers": """
        WITH sums AS (
          SELECT customer_id, SUM(order_amount) AS total_revenue FROM fact_orders GROUP BY customer_id),
        top AS (
          SELECT s.customer_id, c.first_name || ' ' || c.last_name AS customer_name, s.total_revenue
          FROM sums s JOIN dim_customers c ON s.customer_id = c.customer_id
          ORDER BY total_revenue DESC NULLS FIRST, customer_id LIMIT 10),
        counted AS (
          SELECT f.customer_id, COUNT(DISTINCT f.order_id) AS total_orders
          FROM fact_orders f LEFT SEMI JOIN top t ON f.customer_id = t.customer_id GROUP BY f.customer_id)
        SELECT t.customer_id, t.customer_name, t.total_revenue, o.total_orders
        FROM top t JOIN counted o ON t.customer_id = o.customer_id
        ORDER BY t.total_revenue DESC NULLS FIRST, t.customer_id""",
    # One row per day, so the ordered window is small at any size of the fact.
    "vw_sales_anomalies": """
        WITH days AS (
          SELECT order_date AS order_day, SUM(order_amount) AS daily_revenue FROM fact_orders GROUP BY order_date),
        stats AS (
          SELECT order_day, daily_revenue, AVG(CAST(daily_revenue AS DOUBLE)) OVER w AS rolling_avg_7d,
                 STDDEV_SAMP(CAST(daily_revenue AS DOUBLE)) OVER w AS rolling_std_7d
          FROM days WINDOW w AS (ORDER BY order_day ASC NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
        SELECT *, CASE WHEN ABS(CAST(daily_revenue AS DOUBLE) - rolling_avg_7d) > 2 * rolling_std_7d
                       THEN 'ANOMALY' ELSE 'NORMAL' END AS status
        FROM stats""",
}

#: Raw tables that pass through the layers as they are, and the view that staging reads.
PASSED_ON = {
    "raw_clicks": ("analytics_clicks", "staging_clicks"),
    "raw_support_tickets": ("analytics_support_tickets", "staging_support_tickets"),
}
BACKUPS = ("orders_enriched", "dim_customers", "dim_products")
