"""The domain tables as SQL views, written from the raw tables on their own."""

from tidemark.sources.schemas import RETURN_REASONS

_ORDER_ID = "l_orderkey || '-' || l_linenumber"


def _id(prefix: str, number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"


_REASON = " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(RETURN_REASONS))

VIEWS = {
    "order_lines": "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "orders_raw": f"""
        SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE {_ORDER_ID} END AS order_id,
               CASE WHEN l_orderkey % 89 = 0 THEN 'C-UNKNOWN'
                    ELSE {_id('C', 'o_custkey', 6)} END AS customer_id,
               {_id('P', 'l_partkey', 5)} AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CASE WHEN l_orderkey % 83 = 0 THEN NULL
                    WHEN l_orderkey % 79 = 0 THEN -CAST(l_extendedprice AS DECIMAL(12,2))
                    ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS unit_price,
               CASE WHEN l_orderkey % 73 = 0 THEN 'not-a-date'
                    ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS order_ts
        FROM order_lines""",
    "returns_raw": f"""
        SELECT 'R' || {_ORDER_ID} AS return_id,
               CASE WHEN l_orderkey % 67 = 0 THEN 'O-UNKNOWN' ELSE {_ORDER_ID} END AS order_id,
               {_id('C', 'o_custkey', 6)} AS customer_id,
               {_id('P', 'l_partkey', 5)} AS product_id,
               strftime(l_shipdate, '%Y-%m-%d') AS return_date,
               CASE l_suppkey % 6 {_REASON} END AS reason_code,
               CASE WHEN l_orderkey % 71 = 0 THEN -CAST(l_extendedprice AS DECIMAL(12,2))
                    ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS refund_amount
        FROM order_lines WHERE l_returnflag = 'R'""",
    "customer_rows": f"""
        SELECT c_custkey, {_id('C', 'c_custkey', 6)} AS customer_id,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS phone,
               n_name AS city, r_name AS country, lower(n_name) AS region,
               lower(c_mktsegment) AS segment
        FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
        ON c_nationkey = n_nationkey""",
    "customers": "SELECT * EXCLUDE (c_custkey) FROM customer_rows",
    "customers_v1": "SELECT * EXCLUDE (c_custkey) FROM customer_rows WHERE c_custkey % 25 <> 24",
    "customers_v2": """
        SELECT * EXCLUDE (c_custkey) REPLACE (
                 CASE WHEN c_custkey % 10 = 0 THEN 'MOVED' ELSE city END AS city,
                 CASE WHEN c_custkey % 15 = 0 THEN 'new.' || email ELSE email END AS email)
        FROM customer_rows WHERE c_custkey % 50 <> 13""",
    "customer_changes": """
        SELECT a.customer_id AS old_id, b.customer_id AS new_id,
               a.customer_id IS NOT NULL AND b.customer_id IS NOT NULL AND
               (a.email IS DISTINCT FROM b.email OR a.city IS DISTINCT FROM b.city OR
                a.country IS DISTINCT FROM b.country OR a.phone IS DISTINCT FROM b.phone) AS changed
        FROM customers_v1 a FULL JOIN customers_v2 b ON a.customer_id = b.customer_id""",
    "dim_customers": """
        SELECT customer_id, first_name, last_name, segment, email, city, country, phone,
               sha256(concat_ws('|', email, city, country, phone)) AS row_hash,
               NOT changed AS is_current, TIMESTAMP '1995-01-01 00:00:00' AS valid_from,
               CASE WHEN changed THEN TIMESTAMP '1998-01-01 00:00:00'
                    ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to
        FROM customers_v1 JOIN customer_changes ON customer_id = old_id
        UNION ALL
        SELECT customer_id, first_name, last_name, segment, email, city, country, phone,
               sha256(concat_ws('|', email, city, country, phone)),
               TRUE, TIMESTAMP '1998-01-01 00:00:00', TIMESTAMP '9999-12-31 00:00:00'
        FROM customers_v2 JOIN customer_changes ON customer_id = new_id
        WHERE changed OR old_id IS NULL""",
    "product_rows": f"""
        SELECT p_partkey, {_id('P', 'p_partkey', 5)} AS product_id, p_name AS product_name,
               lower(p_type) AS category, p_brand AS brand,
               CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
               CAST(NULL AS VARCHAR) AS supplier_id
        FROM part""",
    "products": "SELECT * EXCLUDE (p_partkey) FROM product_rows",
    "products_v1": "SELECT * EXCLUDE (p_partkey) FROM product_rows WHERE p_partkey % 25 <> 24",
    "products_v2": """
        SELECT * EXCLUDE (p_partkey) REPLACE (
                 CASE WHEN p_partkey % 5 = 0 THEN CAST(unit_price * 1.10 AS DECIMAL(12,2))
                      ELSE unit_price END AS unit_price)
        FROM product_rows WHERE p_partkey % 50 <> 13""",
    "regions": """
        SELECT lower(n_name) AS region_code, n_name AS region_name, r_name AS country,
               'UTC' AS timezone
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "checked_orders": """
        SELECT *, order_id IS NOT NULL AS order_id_present,
               customer_id IN (SELECT customer_id FROM customers) AS customer_known,
               product_id IN (SELECT product_id FROM products) AS product_known,
               coalesce(unit_price > 0, FALSE) AS price_positive,
               try_strptime(order_ts, '%Y-%m-%dT%H:%M:%S') AS order_ts_parsed
        FROM orders_raw""",
    "flagged_orders": """
        SELECT *, order_id_present AND customer_known AND product_known AND price_positive
                  AND order_ts_parsed IS NOT NULL AS ok
        FROM checked_orders""",
    "fct_orders": """
        SELECT order_id, customer_id, product_id, quantity, unit_price,
               CAST(quantity * unit_price AS DECIMAL(18,2)) AS line_total,
               order_ts_parsed AS order_ts
        FROM flagged_orders WHERE ok""",
    "flagged_returns": """
        SELECT *, CAST(try_strptime(return_date, '%Y-%m-%d') AS DATE) AS return_date_parsed,
               return_id IS NOT NULL AND coalesce(refund_amount >= 0, FALSE)
               AND order_id IN (SELECT order_id FROM fct_orders) AS ok
        FROM returns_raw""",
    "fct_returns": """
        SELECT return_id, order_id, customer_id, product_id, return_date_parsed AS return_date,
               reason_code, refund_amount
        FROM flagged_returns WHERE ok""",
    "placed_orders": """
        SELECT o.*, p.category AS product_category, c.region
        FROM fct_orders o JOIN products p ON o.product_id = p.product_id
        JOIN customers c ON o.customer_id = c.customer_id""",
    "as_of": "SELECT max(o_orderdate) AS t FROM orders",
    "customer_metrics": """
        SELECT c.customer_id, c.first_name, c.last_name, c.city, c.country, c.segment,
               coalesce(total_orders, 0) AS total_orders,
               CAST(coalesce(total_spend, 0) AS DECIMAL(28,2)) AS total_spend,
               last_order_ts,
               CAST(coalesce(avg_order_value, 0) AS DECIMAL(28,2)) AS avg_order_value,
               CAST(date_diff('day', CAST(last_order_ts AS DATE),
                              CAST((SELECT t FROM as_of) AS DATE)) AS INTEGER) AS days_since_last_order,
               coalesce(total_returns, 0) AS total_returns,
               CAST(coalesce(total_refunded, 0) AS DECIMAL(28,2)) AS total_refunded
        FROM customers c
        LEFT JOIN (SELECT customer_id, count(order_id) AS total_orders,
                          sum(line_total) AS total_spend, max(order_ts) AS last_order_ts,
                          ((2 * CAST(sum(line_total) * 100 AS HUGEINT) + count(*)) // (2 * count(*)))
                            / CAST(100 AS DECIMAL(5,2)) AS avg_order_value
                   FROM fct_orders GROUP BY customer_id) o ON o.customer_id = c.customer_id
        LEFT JOIN (SELECT customer_id, count(return_id) AS total_returns,
                          sum(refund_amount) AS total_refunded
                   FROM fct_returns GROUP BY customer_id) r ON r.customer_id = c.customer_id""",
    "product_trend": """
        SELECT p.product_id, p.product_name, p.category, p.brand, p.unit_price,
               CAST(coalesce(g, 0) AS DECIMAL(28,2)) AS gmv_7d,
               CAST(coalesce(u, 0) AS BIGINT) AS units_7d,
               CAST(coalesce(q, 0) AS DECIMAL(28,2)) AS gmv_prior_7d,
               CAST(CASE WHEN coalesce(q, 0) = 0 THEN 0 ELSE
                 sign(coalesce(g, 0) - q) *
                 ((20000 * CAST(abs(coalesce(g, 0) - q) * 100 AS HUGEINT) + CAST(q * 100 AS HUGEINT))
                   // (2 * CAST(q * 100 AS HUGEINT))) END / 100.0 AS DECIMAL(18,2)) AS trend_score
        FROM products p LEFT JOIN (
          SELECT product_id,
                 sum(line_total) FILTER (order_ts >= t - INTERVAL 7 DAY AND order_ts < t) AS g,
                 sum(quantity) FILTER (order_ts >= t - INTERVAL 7 DAY AND order_ts < t) AS u,
                 sum(line_total) FILTER (order_ts >= t - INTERVAL 14 DAY
                                         AND order_ts < t - INTERVAL 7 DAY) AS q
          FROM fct_orders, as_of GROUP BY product_id) s ON s.product_id = p.product_id""",
    "daily_revenue": """
        SELECT order_date, num_orders, CAST(gross AS DECIMAL(28,2)) AS gross_revenue,
               CAST(coalesce(refunds, 0) AS DECIMAL(28,2)) AS total_refunds,
               CAST(gross - coalesce(refunds, 0) AS DECIMAL(28,2)) AS net_revenue
        FROM (SELECT CAST(order_ts AS DATE) AS order_date, count(order_id) AS num_orders,
                     sum(line_total) AS gross FROM fct_orders GROUP BY 1)
        LEFT JOIN (SELECT return_date, sum(refund_amount) AS refunds
                   FROM fct_returns GROUP BY 1) ON return_date = order_date""",
}
