"""The registered queries as ANSI SQL over the same tables."""

from __future__ import annotations

ORDERS = """heads AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_totalprice AS DECIMAL(10,2)) AS order_amount
  FROM orders)"""

CUSTOMERS = """cust AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         CAST(NULL AS VARCHAR) AS phone, n_name AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

PRODUCTS = """prod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM part)"""

FAULTY_PRODUCTS = """fprod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
         CASE WHEN p_partkey % 13 = 0 THEN NULL
              WHEN p_partkey % 103 = 0
                THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 50 AS DECIMAL(10,2))
              WHEN p_partkey % 7 = 0
                THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) - 850 AS DECIMAL(10,2))
              WHEN p_partkey % 5 = 0
                THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) - 899 AS DECIMAL(10,2))
              ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS price,
         'USD' AS currency, CAST(p_size AS DECIMAL(18,0)) AS stock_quantity
  FROM part)"""

LINES = """lines AS (
  SELECT l_orderkey AS k, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
         CAST(l_partkey AS VARCHAR) AS pk, CAST(o_custkey AS VARCHAR) AS ck,
         CAST(o_orderdate AS DATE) AS od, CAST(l_quantity AS DECIMAL(18,0)) AS q,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS amt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def date_text(key: str, day: str) -> str:
    return (
        f"CASE {key} % 4 WHEN 0 THEN strftime({day}, '%Y-%m-%d') "
        f"WHEN 1 THEN strftime({day}, '%Y/%m/%d') "
        f"WHEN 2 THEN strftime({day}, '%m/%d/%Y') ELSE 'unknown' END"
    )


def tolerant(text: str) -> str:
    return (
        f"CAST(COALESCE(try_strptime({text}, '%Y-%m-%d'), try_strptime({text}, '%Y/%m/%d'), "
        f"try_strptime({text}, '%m/%d/%Y')) AS DATE)"
    )


LOOSE_ORDERS = f"""{LINES}, loose AS (
  SELECT CASE WHEN k % 101 <> 0 THEN id END AS order_id,
         CASE WHEN k % 97 <> 0 THEN ck END AS customer_id,
         CASE WHEN k % 83 <> 0 THEN pk END AS product_id,
         {date_text('k', 'od')} AS order_date,
         CASE WHEN k % 79 = 0 THEN 'n/a' WHEN k % 73 = 0 THEN '-' || CAST(q AS VARCHAR)
              ELSE CAST(q AS VARCHAR) END AS quantity,
         CASE WHEN k % 71 = 0 THEN 'free' ELSE CAST(amt AS VARCHAR) END AS total_amount,
         'USD' AS currency
  FROM lines)"""

FAULTY_ORDERS = f"""{LINES}, faulty AS (
  SELECT id AS order_id,
         CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN 'gone-' || ck ELSE ck END
           AS customer_id,
         CASE WHEN k % 83 = 0 THEN 'gone-' || pk ELSE pk END AS product_id,
         od AS order_date,
         CASE WHEN k % 199 = 0 THEN CAST(q * 1000 AS DECIMAL(18,0)) ELSE q END AS quantity,
         amt AS total_amount
  FROM lines)"""

ENRICHED = f"""{FAULTY_ORDERS}, {FAULTY_PRODUCTS}, enriched AS (
  SELECT f.order_id, f.customer_id, f.product_id, f.quantity, p.price, f.order_date,
         f.quantity * p.price AS order_amount
  FROM faulty f LEFT JOIN fprod p ON f.product_id = p.product_id)"""


def calendar(day: str) -> str:
    return f"""{day} AS date_key, CAST(year({day}) AS INTEGER) AS "year",
      lpad(CAST(month({day}) AS VARCHAR), 2, '0') AS month_num,
      strftime({day}, '%b') AS month_name, CAST(quarter({day}) AS INTEGER) AS "quarter",
      CAST(weekofyear({day}) AS INTEGER) AS week_of_year,
      CAST(day({day}) AS INTEGER) AS day_of_month, strftime({day}, '%Y-%m-%d') AS date_iso"""


def money(expression: str, alias: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 2) AS {alias}"


def issues(null_policy: str) -> str:
    """The issue log over the enriched faulty lines."""
    price_known = "TRUE" if null_policy == "omit" else "s.price_gaps = 0"
    return f"""WITH {ENRICHED}, {CUSTOMERS},
    s AS (SELECT avg(CAST(quantity AS DOUBLE)) AS q_mean,
                 stddev_pop(CAST(quantity AS DOUBLE)) AS q_dev,
                 avg(CAST(price AS DOUBLE)) AS p_mean, stddev_pop(CAST(price AS DOUBLE)) AS p_dev,
                 count(*) - count(price) AS price_gaps FROM enriched),
    far AS (SELECT e.*, s.* FROM enriched e CROSS JOIN s),
    log AS (
      SELECT 'outlier_quantity' AS issue_type, order_id, 'quantity' AS column_name,
             CAST(quantity AS VARCHAR) AS bad_value,
             'Compare with average quantity across products.' AS suggestion
      FROM far s WHERE abs(CAST(quantity AS DOUBLE) - q_mean) > 3 * q_dev
      UNION ALL
      SELECT 'outlier_price', order_id, 'price', CAST(price AS VARCHAR),
             'Compare with average price across products.'
      FROM far s WHERE {price_known} AND abs(CAST(price AS DOUBLE) - p_mean) > 3 * p_dev
      UNION ALL
      SELECT 'orphan_customer_id', order_id, 'customer_id', customer_id,
             'Check customer table or assign to ''Unknown Customer''.'
      FROM enriched e ANTI JOIN cust c ON e.customer_id = c.customer_id
      UNION ALL
      SELECT 'orphan_product_id', order_id, 'product_id', product_id,
             'Validate product mapping or assign to ''Unknown Product''.'
      FROM enriched e ANTI JOIN fprod p ON e.product_id = p.product_id)
    SELECT 'run-1' AS run_id, issue_type, order_id, column_name, bad_value, suggestion,
           CASE WHEN issue_type LIKE 'outlier%'
                THEN 'Flagged Order ID: ' || order_id || ' for unusual ' || column_name || '='
                     || bad_value || '. Suggestion: ' || suggestion
                ELSE 'Order ID: ' || order_id || ' has invalid ' || column_name || '='
                     || COALESCE(bad_value, 'None') || '. Suggestion: ' || suggestion
           END AS issue_description
    FROM log"""


def imputed(source: str) -> str:
    """Median fills, each taken anew after the rows before it."""
    return f"""WITH src AS ({source}),
    s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd, count(*) AS n FROM src),
    ranked AS (SELECT value, row_number() OVER (ORDER BY value) AS r FROM src),
    mid AS (SELECT min(value) AS a, max(value) AS b FROM ranked
            WHERE r IN (SELECT (n + 1) // 2 FROM s UNION ALL SELECT n // 2 + 1 FROM s)),
    flagged AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS j
                FROM src CROSS JOIN s WHERE abs(value - m) > 3 * sd),
    steps AS (SELECT event_id, j, (b - a) / power(2.0, least(j, 1000)) AS step,
                     CASE WHEN value < a THEN (b - a) / power(2.0, least(j, 1000)) ELSE 0.0 END
                       AS lift FROM flagged CROSS JOIN mid),
    fills AS (SELECT event_id, a + step + COALESCE(sum(lift) OVER (
                ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS fill
              FROM steps CROSS JOIN mid)
    SELECT src.event_id, round(COALESCE(fill, value), 6) AS value
    FROM src LEFT JOIN fills ON src.event_id = fills.event_id"""


TOP_TEN = f"""{ORDERS}, top10 AS (
  SELECT customer_id, sum(order_amount) AS total_revenue FROM heads GROUP BY customer_id
  ORDER BY total_revenue DESC NULLS FIRST, customer_id LIMIT 10)"""


def segmented(source: str) -> str:
    return f"""edges AS (
      SELECT percentile_cont(1.0/3) WITHIN GROUP (ORDER BY CAST(total_revenue AS DOUBLE)) AS e1,
             percentile_cont(2.0/3) WITHIN GROUP (ORDER BY CAST(total_revenue AS DOUBLE)) AS e2
      FROM {source}),
    tiers AS (SELECT customer_id, total_revenue,
                     CASE WHEN total_revenue <= e1 THEN 1 WHEN total_revenue <= e2 THEN 2
                          ELSE 3 END AS segment_rank
              FROM {source} CROSS JOIN edges),
    named AS (SELECT *, CASE segment_rank WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' ELSE 'High' END
                AS segment FROM tiers)"""


PAGE = "'/' || event_type || '/' || CAST(event_id % 7 AS VARCHAR)"
DEVICE = "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'tablet' WHEN 2 THEN 'phone' ELSE 'desktop' END"

CLICKS = """late AS (SELECT max(ts) - INTERVAL 1 HOUR AS passed FROM events)"""

ORACLES: dict[str, str] = {
    "sales_anomalies": f"""WITH {ORDERS},
      days AS (SELECT order_date AS order_day, sum(order_amount) AS daily_revenue
               FROM heads GROUP BY order_date),
      stats AS (SELECT order_day, CAST(daily_revenue AS DOUBLE) AS x,
                       avg(CAST(daily_revenue AS DOUBLE)) OVER w AS m,
                       stddev_samp(CAST(daily_revenue AS DOUBLE)) OVER w AS sd
                FROM days WINDOW w AS (ORDER BY order_day NULLS LAST
                                       ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
      SELECT order_day, round(x, 2) AS daily_revenue, round(m, 2) AS rolling_avg_7d,
             round(sd, 2) AS rolling_std_7d,
             CASE WHEN abs(x - m) > 2 * sd THEN 'ANOMALY' ELSE 'NORMAL' END AS status
      FROM stats""",
    "sales_anomalies_text": f"""WITH {ORDERS},
      texts AS (SELECT CASE WHEN CAST(order_id AS BIGINT) % 4 < 3 THEN order_date END AS order_day,
                       order_amount FROM heads),
      days AS (SELECT order_day, CAST(sum(order_amount) AS DOUBLE) AS x FROM texts GROUP BY 1),
      stats AS (SELECT order_day, x, avg(x) OVER w AS m, stddev_samp(x) OVER w AS sd
                FROM days WINDOW w AS (ORDER BY order_day NULLS LAST
                                       ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
      SELECT order_day, round(x, 2) AS daily_revenue, round(m, 2) AS rolling_avg_7d,
             CASE WHEN abs(x - m) > 2 * sd THEN 'ANOMALY' ELSE 'NORMAL' END AS status
      FROM stats""",
    "top_customers": f"""WITH {TOP_TEN}
      SELECT customer_id, {money('total_revenue', 'total_revenue')} FROM top10""",
    "top_customers_by_lines": f"""WITH {ENRICHED}
      SELECT customer_id, {money('sum(order_amount)', 'total_revenue')} FROM enriched
      GROUP BY customer_id
      ORDER BY sum(order_amount) DESC NULLS FIRST, customer_id NULLS LAST LIMIT 10""",
    "top_customers_named": f"""WITH {ORDERS}, {CUSTOMERS}
      SELECT c.customer_id, first_name || ' ' || last_name AS customer_name,
             {money('sum(order_amount)', 'total_revenue')},
             count(DISTINCT order_id) AS total_orders
      FROM heads h JOIN cust c ON h.customer_id = c.customer_id GROUP BY 1, 2
      ORDER BY sum(order_amount) DESC NULLS FIRST, c.customer_id LIMIT 10""",
    "customer_spend": f"""WITH {ORDERS}, {CUSTOMERS}
      SELECT first_name || ' ' || last_name AS customer_name,
             {money('sum(order_amount)', 'total_spent')}, count(*) AS orders_cnt
      FROM heads h JOIN cust c ON h.customer_id = c.customer_id GROUP BY 1
      ORDER BY sum(order_amount) DESC NULLS FIRST, customer_name LIMIT 10""",
    "product_category_sales": f"""WITH {PRODUCTS}
      SELECT category, {money('sum(CAST(l_quantity AS DECIMAL(18,0)) * price)',
                              'category_revenue')}
      FROM lineitem JOIN prod ON CAST(l_partkey AS VARCHAR) = product_id GROUP BY category""",
    "revenue_by_month": f"""WITH {ORDERS}
      SELECT CAST(year(order_date) AS INTEGER) AS "year",
             lpad(CAST(month(order_date) AS VARCHAR), 2, '0') AS month_num,
             strftime(order_date, '%b') AS month_name, {money('sum(order_amount)', 'revenue')}
      FROM heads GROUP BY 1, 2, 3""",
    "new_customers_daily": """WITH firsts AS (
        SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS signup_date FROM orders GROUP BY 1)
      SELECT signup_date, count(*) AS new_customers FROM firsts GROUP BY signup_date""",
    "customers_by_country": f"""WITH {CUSTOMERS}
      SELECT country, count(*) AS total_customers FROM cust GROUP BY country""",
    "full_names": f"""WITH {CUSTOMERS}, partly AS (
        SELECT customer_id, first_name,
               CASE WHEN CAST(customer_id AS BIGINT) % 7 <> 0 THEN last_name END AS last_name
        FROM cust)
      SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name
      FROM partly""",
    "sales_forecast": f"""WITH {ORDERS},
      days AS (SELECT order_date, CAST(sum(order_amount) AS DOUBLE) AS y FROM heads GROUP BY 1),
      ends AS (SELECT min(order_date) AS f, max(order_date) AS l FROM days),
      fit AS (SELECT regr_slope(y, order_date - f) AS slope,
                     regr_intercept(y, order_date - f) AS icept FROM days CROSS JOIN ends),
      ahead AS (SELECT CAST(unnest(generate_series(l + 1, l + 30, INTERVAL 1 DAY)) AS DATE) AS d
                FROM ends)
      SELECT d AS forecast_day, round(icept + slope * (d - f), 2) AS expected_revenue
      FROM ahead CROSS JOIN fit CROSS JOIN ends""",
    "dim_date_calendar": f"""WITH texts AS (
        SELECT {date_text('o_orderkey', 'CAST(o_orderdate AS DATE)')} AS t FROM orders),
      ends AS (SELECT min({tolerant('t')}) AS f, max({tolerant('t')}) AS l FROM texts),
      days AS (SELECT CAST(unnest(generate_series(f, l, INTERVAL 1 DAY)) AS DATE) AS d FROM ends)
      SELECT {calendar('d')} FROM days""",
    "dim_date_observed": f"""WITH days AS (
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
      SELECT {calendar('d')} FROM days""",
    "dim_customers_conformed": f"""WITH {CUSTOMERS} SELECT * FROM cust""",
    "dim_products_conformed": """
      SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
             p_type AS category,
             CASE WHEN p_partkey % 11 = 0 OR p_partkey % 17 = 0 THEN NULL
                  ELSE p_retailprice END AS price,
             'USD' AS currency,
             CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END
               AS stock_quantity
      FROM part""",
    "fact_orders_conformed": f"""WITH {LOOSE_ORDERS}, typed AS (
        SELECT order_id, customer_id, product_id, {tolerant('order_date')} AS order_date,
               CAST(TRY_CAST(quantity AS DECIMAL(18,0)) AS DOUBLE) AS quantity,
               CAST(TRY_CAST(total_amount AS DECIMAL(10,2)) AS DOUBLE) AS total_amount, currency
        FROM loose WHERE order_id IS NOT NULL)
      SELECT * FROM typed WHERE order_date IS NOT NULL AND quantity >= 0""",
    "orders_enriched": f"""WITH {ENRICHED}
      SELECT order_id, customer_id, product_id, CAST(quantity AS DOUBLE) AS quantity,
             CAST(price AS DOUBLE) AS price, CAST(order_amount AS DOUBLE) AS order_amount,
             order_date FROM enriched""",
    "orders_enriched_salted": f"""WITH {ENRICHED}
      SELECT order_id, customer_id, product_id, CAST(quantity AS DOUBLE) AS quantity,
             CAST(price AS DOUBLE) AS price, CAST(order_amount AS DOUBLE) AS order_amount
      FROM enriched""",
    "product_summary": f"""WITH {FAULTY_PRODUCTS}
      SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, currency,
             CAST(stock_quantity AS DOUBLE) AS stock_quantity,
             CASE WHEN price >= 100 THEN 'High' WHEN price >= 50 THEN 'Medium' ELSE 'Low' END
               AS revenue_bucket
      FROM fprod""",
    "row_counts": """
      SELECT 'raw_customers' AS table_name, count(*) AS total_rows FROM customer
      UNION ALL SELECT 'raw_products', count(*) FROM part
      UNION ALL SELECT 'raw_orders', count(*) FROM lineitem
      UNION ALL SELECT 'raw_clicks', count(*) FROM events""",
    "missing_keys": f"""WITH {LOOSE_ORDERS}
      SELECT count(*) - count(order_id) AS missing_order_id,
             count(*) - count(customer_id) AS missing_customer_id,
             count(*) - count(product_id) AS missing_product_id FROM loose""",
    "orphan_counts": f"""WITH {FAULTY_ORDERS}, {CUSTOMERS}, {PRODUCTS}
      SELECT 'customers' AS missing, count(*) AS n
      FROM faulty f LEFT JOIN cust c ON f.customer_id = c.customer_id
      WHERE c.customer_id IS NULL
      UNION ALL
      SELECT 'products', count(*)
      FROM faulty f LEFT JOIN prod p ON f.product_id = p.product_id
      WHERE p.product_id IS NULL""",
    "orphan_orders": f"""WITH {FAULTY_ORDERS}, {CUSTOMERS}
      SELECT f.order_id, f.customer_id, f.product_id
      FROM faulty f LEFT JOIN cust c ON f.customer_id = c.customer_id
      WHERE c.customer_id IS NULL""",
    "product_profile": f"""WITH {FAULTY_PRODUCTS}
      SELECT count(*) AS total_products, count(DISTINCT product_id) AS unique_products,
             {money('min(price)', 'min_price')}, {money('max(price)', 'max_price')},
             {money('avg(price)', 'avg_price')} FROM fprod""",
    "numeric_profile": f"""WITH {FAULTY_ORDERS}
      SELECT count(*) AS total_orders, {money('min(quantity)', 'min_qty')},
             {money('max(quantity)', 'max_qty')}, {money('avg(quantity)', 'avg_qty')},
             {money('min(total_amount)', 'min_amount')},
             {money('max(total_amount)', 'max_amount')},
             {money('avg(total_amount)', 'avg_amount')} FROM faulty""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
      WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "not_null_failures": f"""WITH {FAULTY_ORDERS}
      SELECT order_id, product_id, strftime(order_date, '%Y-%m-%d') AS order_date
      FROM faulty WHERE customer_id IS NULL""",
    "null_default_fill": f"""WITH {FAULTY_ORDERS}
      SELECT COALESCE(customer_id, 'unknown') AS customer_id, count(*) AS orders
      FROM faulty GROUP BY 1""",
    "deduped_customers": f"""WITH {CUSTOMERS}
      SELECT customer_id, first_name, last_name, country FROM cust""",
    "outlier_flags": """WITH s AS (
        SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events)
      SELECT event_id, value FROM events CROSS JOIN s WHERE abs(value - m) > 3 * sd""",
    "outlier_imputed": imputed("SELECT event_id, value FROM events"),
    "outlier_imputed_stepwise": imputed(
        """SELECT o_orderkey AS event_id,
             CASE WHEN o_orderkey % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END
             * (o_totalprice + 4000.0::DOUBLE)
             * CASE WHEN o_orderkey % 400 IN (0, 1, 5) THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END
             / 3.0::DOUBLE AS value FROM orders"""
    ),
    "issue_log": issues("propagate"),
    "issue_log_known_prices": issues("omit"),
    "orphan_imputed": f"""WITH {FAULTY_ORDERS}, {CUSTOMERS}, {PRODUCTS}
      SELECT f.order_id, COALESCE(c.customer_id, '-1') AS customer_id,
             COALESCE(p.product_id, '-1') AS product_id
      FROM faulty f LEFT JOIN cust c ON f.customer_id = c.customer_id
      LEFT JOIN prod p ON f.product_id = p.product_id""",
    "high_value_orders": f"""WITH {ORDERS}
      SELECT order_id, customer_id, order_date, CAST(order_amount AS DOUBLE) AS order_amount
      FROM heads
      WHERE order_amount > (SELECT percentile_cont(0.9) WITHIN GROUP
                              (ORDER BY CAST(order_amount AS DOUBLE)) FROM heads)""",
    "high_value_orders_tied": f"""WITH {ORDERS}, tied AS (
        SELECT order_id, customer_id, order_date,
               CAST(floor(order_amount / 50000) * 0.29 AS DECIMAL(12,2)) AS a FROM heads)
      SELECT order_id, customer_id, order_date, CAST(a AS DOUBLE) AS order_amount FROM tied
      WHERE CAST(a AS DOUBLE) > (SELECT percentile_cont(0.9) WITHIN GROUP
                                   (ORDER BY CAST(a AS DOUBLE)) FROM tied)""",
    "quantile_profile": f"""WITH {ORDERS}, q AS (
        SELECT percentile_cont(1.0/3) WITHIN GROUP (ORDER BY CAST(order_amount AS DOUBLE)) AS a,
               percentile_cont(0.5) WITHIN GROUP (ORDER BY CAST(order_amount AS DOUBLE)) AS b,
               percentile_cont(2.0/3) WITHIN GROUP (ORDER BY CAST(order_amount AS DOUBLE)) AS c,
               percentile_cont(0.9) WITHIN GROUP (ORDER BY CAST(order_amount AS DOUBLE)) AS d
        FROM heads)
      SELECT count(*) AS n, round(any_value(a), 4) AS p33_value,
             count(*) FILTER (WHERE order_amount <= a) AS p33_rows,
             round(any_value(b), 4) AS p50_value,
             count(*) FILTER (WHERE order_amount <= b) AS p50_rows,
             round(any_value(c), 4) AS p67_value,
             count(*) FILTER (WHERE order_amount <= c) AS p67_rows,
             round(any_value(d), 4) AS p90_value,
             count(*) FILTER (WHERE order_amount <= d) AS p90_rows
      FROM heads CROSS JOIN q""",
    "customer_segments": f"""WITH {TOP_TEN}, {segmented('top10')}
      SELECT customer_id, {money('total_revenue', 'total_revenue')}, segment,
             CAST(segment_rank AS INTEGER) AS segment_rank FROM named""",
    "all_customer_segments": f"""WITH {ORDERS}, spent AS (
        SELECT customer_id, sum(order_amount) AS total_revenue FROM heads GROUP BY customer_id),
      {segmented('spent')}
      SELECT customer_id, {money('total_revenue', 'total_revenue')}, segment,
             CAST(segment_rank AS INTEGER) AS segment_rank FROM named""",
    "segment_revenue": f"""WITH {TOP_TEN}, {segmented('top10')}
      SELECT segment, CAST(segment_rank AS INTEGER) AS segment_rank, count(*) AS members,
             {money('sum(total_revenue)', 'total_revenue')} FROM named GROUP BY 1, 2""",
    "category_share": f"""WITH {PRODUCTS}, sales AS (
        SELECT category, sum(CAST(l_quantity AS DECIMAL(18,0)) * price) AS r
        FROM lineitem JOIN prod ON CAST(l_partkey AS VARCHAR) = product_id GROUP BY category)
      SELECT category, {money('r', 'category_revenue')},
             round(CAST(r AS DOUBLE) / (SELECT CAST(sum(r) AS DOUBLE) FROM sales), 6) AS share
      FROM sales""",
    "csv_ingest": """WITH loose AS (
        SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               p_type AS category,
               CASE WHEN p_partkey % 11 = 0 THEN 'n/a'
                    WHEN p_partkey % 17 = 0 THEN '99999999999.99'
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS price,
               CASE WHEN p_partkey % 19 = 0 THEN 'many' ELSE CAST(p_size AS VARCHAR) END
                 AS stock_quantity
        FROM part),
      raw AS (SELECT *, CASE stock_quantity WHEN '7' THEN NULL WHEN '8' THEN NULL
                     WHEN '9' THEN 'a currency name that is too long' ELSE 'US,D' END AS currency,
                     price = 'n/a' AND k % 2 = 0 AS echo FROM loose),
      checked AS (SELECT *, CASE WHEN echo THEN 'header_echo'
                       WHEN TRY_CAST(price AS DECIMAL(10,2)) IS NULL THEN 'bad_number:price'
                       WHEN length(currency) > 10 THEN 'too_long:currency'
                       WHEN TRY_CAST(stock_quantity AS DECIMAL(18,0)) IS NULL
                         THEN 'bad_number:stock_quantity' END AS reject_reason FROM raw)
      SELECT CASE WHEN echo THEN 'PRODUCT_ID' ELSE product_id END AS product_id,
             CASE WHEN echo THEN 'PRODUCT_NAME' ELSE product_name END AS product_name,
             CASE WHEN echo THEN 'CATEGORY' ELSE category END AS category,
             CASE WHEN echo THEN 'PRICE' ELSE price END AS price,
             CASE WHEN echo THEN 'CURRENCY' ELSE currency END AS currency,
             CASE WHEN echo THEN 'STOCK_QUANTITY' ELSE stock_quantity END AS stock_quantity,
             reject_reason FROM checked""",
    "customer_transform": f"""WITH {CUSTOMERS}
      SELECT *, first_name || ' ' || last_name AS full_name FROM cust""",
    "csv_multiline": """SELECT CAST(p_partkey AS VARCHAR) AS product_id,
             p_name || CASE WHEN p_partkey % 3 = 0 THEN chr(10) || '"second" line, more' ELSE '' END
               AS product_name, FALSE AS rejected FROM part""",
    "store_roundtrip": f"""WITH {ORDERS}, kept AS (
        SELECT order_id FROM heads WHERE order_amount > 400000)
      SELECT 'orders' AS table_name, count(*) AS n_rows, count(DISTINCT order_id) AS n_orders,
             CAST(sum(order_amount * 2) AS DOUBLE) AS amount FROM heads
      UNION ALL SELECT 'amounts', count(*), count(DISTINCT order_id),
             CAST(sum(order_amount) AS DOUBLE) FROM heads
      UNION ALL SELECT 'orders_backup', count(*), count(DISTINCT order_id),
             CAST(sum(order_amount * 2) AS DOUBLE) FROM heads
      UNION ALL SELECT 'issues', 2 * count(*), count(DISTINCT order_id), NULL FROM kept
      UNION ALL SELECT 'loaded', count(*), count(DISTINCT order_id),
             CAST(sum(order_amount) AS DOUBLE) FROM heads""",
    "views_and_models": """WITH first_model AS (
        SELECT CAST(1 AS BIGINT) AS id UNION ALL SELECT NULL UNION ALL
        SELECT c_custkey FROM customer),
      second_model AS (SELECT id FROM first_model WHERE id = 1)
      SELECT 'my_first_model' AS model, count(*) AS n_rows, count(*) - count(id) AS null_ids,
             count(id) - count(DISTINCT id) AS repeated_ids, CAST(1 AS BIGINT) AS stored_tables
      FROM first_model
      UNION ALL
      SELECT 'my_second_model', count(*), count(*) - count(id), count(id) - count(DISTINCT id), 0
      FROM second_model""",
    "catalog_listing": """SELECT * FROM (VALUES
        ('orders', 'table', 1, 'order_id', 'string'), ('orders', 'table', 2, 'customer_id', 'string'),
        ('orders', 'table', 3, 'order_date', 'date'), ('orders', 'table', 4, 'order_amount', 'decimal(10,2)'),
        ('orders', 'table', 5, 'total_amount', 'decimal(10,2)'),
        ('vw_large', 'view', 1, 'order_id', 'string'), ('vw_large', 'view', 2, 'total', 'decimal(10,2)'),
        ('vw_orders', 'view', 1, 'order_id', 'string'), ('vw_orders', 'view', 2, 'total', 'decimal(10,2)'),
        ('ledgerloom_listed', 'temporary view', 1, 'customer_id', 'string'))
        AS t(relation, kind, "position", col_name, data_type)""",
    "preview_rows": f"""WITH {CUSTOMERS}
      SELECT customer_id, first_name, last_name, country FROM cust
      ORDER BY customer_id LIMIT 5""",
    "query_to_frame": f"""WITH {ORDERS}
      SELECT customer_id, count(*) AS orders FROM heads WHERE order_amount > 250000
      GROUP BY customer_id""",
    "star_row_counts": f"""WITH {ENRICHED}, {CUSTOMERS},
      s AS (SELECT avg(CAST(quantity AS DOUBLE)) AS m, stddev_pop(CAST(quantity AS DOUBLE)) AS sd
            FROM enriched)
      SELECT 'dim_customers_conformed' AS table_name, count(*) AS total_rows FROM customer
      UNION ALL SELECT 'dim_products_conformed', count(*) FROM part
      UNION ALL SELECT 'dim_date_conformed', max(order_date) - min(order_date) + 1 FROM faulty
      UNION ALL SELECT 'fact_orders_conformed', count(*) FROM faulty
      UNION ALL SELECT 'orders_enriched', count(*) FROM enriched
      UNION ALL SELECT 'dim_date', count(DISTINCT order_date) FROM faulty
      UNION ALL SELECT 'fact_orders', count(*) FROM enriched
      UNION ALL SELECT 'fact_orders_clean', count(*) FROM enriched
      UNION ALL SELECT 'data_quality_issues', (
          SELECT count(*) FROM enriched CROSS JOIN s
          WHERE abs(CAST(quantity AS DOUBLE) - m) > 3 * sd)
        + (SELECT count(*) FROM enriched e ANTI JOIN cust c ON e.customer_id = c.customer_id)
        + (SELECT count(*) FROM enriched e ANTI JOIN fprod p ON e.product_id = p.product_id)""",
    "scalar_functions": f"""WITH o AS (
        SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, o_orderpriority, o_totalprice,
               {date_text('o_orderkey', 'CAST(o_orderdate AS DATE)')} AS t,
               CASE WHEN o_orderkey % 3 = 0 THEN 'x'
                    ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) END AS n
        FROM orders)
      SELECT k, o_orderpriority AS trimmed, o_orderpriority || ' ' || t AS joined,
             {calendar('d')}, {tolerant('t')} AS tolerant,
             CAST(try_strptime(t, '%Y-%m-%d') AS DATE) AS iso_only, d AS strict,
             CAST(TRY_CAST(n AS DECIMAL(10,2)) AS DOUBLE) AS as_decimal,
             CAST(TRY_CAST(n AS DECIMAL(18,0)) AS BIGINT) AS as_number, d AS day_start,
             d + 30 AS day_plus, DATE '2025-09-05' - 365 AS year_before,
             CAST(abs(CAST(o_totalprice AS DECIMAL(12,2)) - 250000) AS DOUBLE) AS gap,
             CASE WHEN o_totalprice / 5000 >= 100 THEN 'High'
                  WHEN o_totalprice / 5000 >= 50 THEN 'Medium' ELSE 'Low' END AS bucket
      FROM o""",
    "stream_daily_clicks": """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS clicks
      FROM events GROUP BY 1, 2""",
    "stream_closed_days": f"""WITH {CLICKS}
      SELECT CAST(ts AS DATE) AS day, count(*) AS clicks FROM events CROSS JOIN late
      WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= passed GROUP BY 1""",
    "stream_sessions": f"""WITH {CLICKS},
      steps AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before
                FROM events),
      marked AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL
                     OR ts - before >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                   OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s
                 FROM steps),
      sessions AS (SELECT user_id, s, min(ts) AS a, max(ts) + INTERVAL 30 MINUTE AS b,
                          count(*) AS clicks FROM marked GROUP BY 1, 2)
      SELECT user_id AS customer_id, epoch_us(a) AS start_micros, epoch_us(b) AS end_micros,
             clicks FROM sessions CROSS JOIN late WHERE b <= passed""",
    "stream_dedup": """SELECT event_id AS click_id, user_id AS customer_id, event_type, value
      FROM events""",
    "stream_alerts": """WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events)
      SELECT event_id AS click_id, user_id AS customer_id, value,
             'outlier_value' AS issue_type
      FROM events CROSS JOIN s WHERE abs(value - m) > 3 * sd
      UNION ALL
      SELECT event_id, user_id, value, 'orphan_customer_id' FROM events
      WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 13 <> 0)""",
    "stream_enriched": """SELECT event_id AS click_id, user_id AS customer_id, event_type,
             c_name, c_mktsegment
      FROM events LEFT JOIN customer ON user_id = c_custkey AND c_custkey % 13 <> 0""",
    "csv_multiline_ranges": """WITH notes AS (
        SELECT *, CASE WHEN o_orderkey % 4 = 0
          THEN o_orderpriority || chr(10) || '"' || repeat('a, ""b' || chr(10), o_orderkey % 40) || '"'
          ELSE o_orderpriority END AS note FROM orders)
      SELECT CAST(o_orderkey AS VARCHAR) AS ticket_id, CAST(o_custkey AS VARCHAR) AS customer_id,
             CASE WHEN o_orderkey % 9 = 0 THEN 'x,' || chr(10) || ',y' ELSE o_orderstatus END AS issue_category,
             CAST(length(note) AS INTEGER) AS note_length, md5(note) AS note_md5,
             CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS VARCHAR) END
               AS resolution_time_hours FROM notes""",
    "csv_reload": f"""WITH {FAULTY_ORDERS}
      SELECT 'raw_customers' AS table_name, count(*) AS total_rows, count(DISTINCT c_custkey) AS keys,
             count(*) AS rows_read, CAST(0 AS INTEGER) AS files_in_last_load FROM customer
      UNION ALL SELECT 'raw_products', count(*), count(DISTINCT p_partkey), count(*), 0 FROM part
      UNION ALL SELECT 'raw_orders', count(*), count(DISTINCT order_id), count(*), 0 FROM faulty
      UNION ALL SELECT 'raw_clicks', count(*), count(DISTINCT event_id), count(*), 0 FROM events
      UNION ALL SELECT 'raw_support_tickets', count(*), count(DISTINCT c_custkey), count(*), 0 FROM customer""",
    "incremental_load": f"""WITH {ORDERS}, keyed AS (
        SELECT CAST(order_id AS BIGINT) AS order_id, customer_id, order_amount FROM heads),
      ends AS (SELECT max(order_id) AS z FROM keyed)
      SELECT order_id, customer_id,
             CAST(order_amount + CASE WHEN order_id >= 3 * z // 4 THEN 1 ELSE 0 END AS DOUBLE) AS order_amount
      FROM keyed CROSS JOIN ends""",
    "clone_and_vacuum": f"""WITH {ORDERS}, s AS (SELECT count(*) AS n, CAST(sum(order_amount) AS DOUBLE) AS a,
          CAST(sum(CAST(order_amount * 2 AS DECIMAL(10,2))) AS DOUBLE) AS b FROM heads)
      SELECT 'orders' AS table_name, n AS n_rows, b AS amount, CAST(1 AS BIGINT) AS folders_removed FROM s
      UNION ALL SELECT 'orders_backup', 2 * n, 2 * a, 1 FROM s
      UNION ALL SELECT 'orders_copy', 2 * n, 2 * a, 1 FROM s""",
    "lasting_views": f"""WITH {ENRICHED}, {CUSTOMERS}, days AS (SELECT order_date, sum(order_amount) AS r FROM enriched GROUP BY 1),
      named AS (SELECT c.customer_id, first_name || ' ' || last_name AS customer_name, sum(order_amount) AS r
                FROM enriched e JOIN cust c ON e.customer_id = c.customer_id GROUP BY 1, 2
                ORDER BY r DESC NULLS FIRST, 1 LIMIT 10)
      SELECT 'fact_orders' AS relation, count(*) AS n_rows, {money('sum(order_amount)', 'amount')} FROM enriched
      UNION ALL SELECT 'vw_top_customers', count(*), {money('sum(r)', 'amount')} FROM named
      UNION ALL SELECT 'vw_sales_anomalies', count(*), {money('sum(r)', 'amount')} FROM days
      UNION ALL SELECT 'vw_orders', count(*), {money('sum(order_amount)', 'amount')} FROM enriched
      UNION ALL SELECT 'vw_customers', count(*), NULL FROM customer
      UNION ALL SELECT 'vw_products', count(*), NULL FROM part
      UNION ALL SELECT 'staging_clicks', count(*), NULL FROM events
      UNION ALL SELECT 'staging_support_tickets', count(*), NULL FROM customer
      UNION ALL SELECT 'new_customers_daily', count(DISTINCT f), sum(n) FROM (
        SELECT CAST(min(o_orderdate) AS DATE) AS f, 1.0::DOUBLE AS n FROM orders GROUP BY o_custkey)
      UNION ALL SELECT 'orders_enriched_backup', count(*), {money('sum(order_amount)', 'amount')} FROM enriched
      UNION ALL SELECT 'dim_customers_backup', count(*), NULL FROM customer
      UNION ALL SELECT 'dim_products_backup', count(*), NULL FROM part""",
    "layer_reconciliation": f"""WITH {FAULTY_ORDERS}, raw AS (
        SELECT order_id, CAST(split_part(order_id, '-', 1) AS BIGINT) AS k, customer_id FROM faulty)
      SELECT 'raw' AS layer, 'staging' AS next_layer, order_id, 'lost' AS kind, '' AS "columns",
             count(*) AS n_before, CAST(0 AS BIGINT) AS n_after FROM raw WHERE k % 211 = 0 GROUP BY order_id
      UNION ALL SELECT 'staging', 'fact', order_id, 'changed', 'quantity', count(*), count(*)
      FROM raw WHERE k % 211 <> 0 AND k % 307 = 0 GROUP BY order_id
      UNION ALL SELECT 'fact', 'clean', order_id, 'changed', 'customer_id', count(*), count(*)
      FROM raw WHERE k % 211 <> 0 AND customer_id IS NULL GROUP BY order_id
      UNION ALL SELECT 'fact', 'clean', 'new-' || order_id, 'added', '', 0, count(*)
      FROM raw WHERE k % 211 <> 0 AND k % 401 = 0 GROUP BY order_id""",
    "categories_in_order": f"""WITH {PRODUCTS}, sales AS (
        SELECT category, {money('sum(CAST(l_quantity AS DECIMAL(18,0)) * price)', 'category_revenue')}
        FROM lineitem JOIN prod ON CAST(l_partkey AS VARCHAR) = product_id GROUP BY category)
      SELECT CAST(row_number() OVER (ORDER BY category NULLS LAST) AS INTEGER) AS place, * FROM sales""",
    "months_in_order": f"""WITH {ORDERS}, months AS (
        SELECT CAST(year(order_date) AS INTEGER) AS "year",
               lpad(CAST(month(order_date) AS VARCHAR), 2, '0') AS month_num, {money('sum(order_amount)', 'revenue')}
        FROM heads GROUP BY 1, 2)
      SELECT CAST(row_number() OVER (ORDER BY "year", month_num) AS INTEGER) AS place, * FROM months""",
    "stream_sessions_path": f"""WITH {CLICKS},
      steps AS (SELECT user_id, ts, event_id, {PAGE} AS page, {DEVICE} AS device,
                       lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
      marked AS (SELECT *, sum(CASE WHEN before IS NULL OR ts - before >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                   OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM steps),
      firsts AS (SELECT user_id, s, device, min((ts, event_id)) AS moment FROM marked WHERE device IS NOT NULL GROUP BY 1, 2, 3),
      used AS (SELECT user_id, s, string_agg(device, ',' ORDER BY moment) AS devices, arg_min(device, moment) AS device
               FROM firsts GROUP BY 1, 2),
      sessions AS (SELECT user_id, s, min(ts) AS a, max(ts) + INTERVAL 30 MINUTE AS b, count(*) AS clicks,
                          string_agg(page, ' > ' ORDER BY ts, event_id) AS path FROM marked GROUP BY 1, 2)
      SELECT user_id AS customer_id, epoch_us(a) AS start_micros, clicks, device, COALESCE(devices, '') AS devices, path
      FROM sessions LEFT JOIN used USING (user_id, s) CROSS JOIN late WHERE b <= passed""",
    "stream_raw_clicks": f"""WITH m AS (
        SELECT *, CASE WHEN event_id % 13 <> 0 THEN CAST(event_id AS VARCHAR) END AS id,
               CASE WHEN event_id % 19 = 0 THEN rpad({PAGE}, 600, 'x') ELSE {PAGE} END AS page, {DEVICE} AS device,
               CASE WHEN event_id % 17 = 0 THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS moment FROM events),
      body AS (SELECT *, '{{' || CASE WHEN id IS NULL THEN '' ELSE '"click_id":"' || id || '",' END
                 || '"customer_id":"' || CAST(user_id AS VARCHAR) || '","page_url":"' || page || '","click_timestamp":"' || moment || '"'
                 || CASE WHEN device IS NULL THEN '' ELSE ',"device_type":"' || device || '"' END || '}}' AS whole FROM m),
      told AS (SELECT *, event_id % 11 = 0 AS broken, CASE WHEN event_id % 11 = 0 THEN substr(whole, 1, 20) ELSE whole END AS message,
                 CASE WHEN event_id % 11 = 0 THEN 'broken_message' WHEN id IS NULL THEN 'missing:click_id'
                      WHEN event_id % 17 = 0 THEN 'bad_time:click_timestamp'
                      WHEN event_id % 19 = 0 THEN 'too_long:page_url' END AS reject_reason FROM body)
      SELECT 'clicks/' || CAST(event_id % 4 AS VARCHAR) || '/' || CAST(event_id AS VARCHAR) AS place,
             CASE WHEN NOT broken THEN id END AS click_id,
             CASE WHEN NOT broken THEN CAST(user_id AS VARCHAR) END AS customer_id,
             CASE WHEN NOT broken THEN page END AS page_url, CASE WHEN NOT broken THEN moment END AS click_timestamp,
             CASE WHEN NOT broken THEN device END AS device_type, CAST(ts AS DATE) AS arrival_day, reject_reason,
             CASE WHEN reject_reason IS NOT NULL THEN md5(message) END AS message_md5 FROM told""",
    "stream_alert_issues": f"""WITH batch AS ({issues('propagate')}),
      s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events)
      SELECT run_id AS origin, issue_type, order_id, column_name, bad_value AS bad_text, CAST(NULL AS DOUBLE) AS bad_number, suggestion
      FROM batch
      UNION ALL
      SELECT 'clicks', 'outlier_value', CAST(event_id AS VARCHAR), 'value', NULL, value,
             'Compare with the stored history of this measure.'
      FROM events CROSS JOIN s WHERE abs(value - m) > 3 * sd
      UNION ALL
      SELECT 'clicks', 'orphan_customer_id', CAST(event_id AS VARCHAR), 'customer_id', CAST(user_id AS VARCHAR), NULL,
             'Check customer table or assign to ''Unknown Customer''.'
      FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 13 <> 0)""",
}
