"""Gold-table and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.times import day
from tidemark.operators import changes, gold
from tidemark.operators.keys import first_per_key
from tidemark.plans.domain import V1_DATE, V2_DATE, Domain
from tidemark.plans.registry import query
from tidemark.sinks.changelog import ChangeTable
from tidemark.streaming.sinks import TotalsTable

CUSTOMER_COLUMNS = ["customer_id", "first_name", "last_name", "city", "country", "segment"]


def metrics(d: Domain):
    return gold.customer_metrics(
        d.fct_orders, d.fct_returns, d.customers.select(*CUSTOMER_COLUMNS), d.as_of
    )


def trend(d: Domain):
    products = d.products.select("product_id", "product_name", "category", "brand", "unit_price")
    return gold.product_trend_7d(d.recent_orders(14), products, d.as_of)


@query("revenue_daily", "SELECT * FROM daily_revenue ORDER BY order_date")
def revenue_daily(d: Domain):
    return gold.revenue_daily(d.fct_orders, d.fct_returns)


@query("customer_metrics", "SELECT * FROM customer_metrics")
def customer_metrics(d: Domain):
    return metrics(d)


@query(
    "product_performance",
    """SELECT p.product_id, p.product_name, p.category, p.unit_price,
              coalesce(n, 0) AS total_units_sold,
              CAST(coalesce(s, 0) AS DECIMAL(28,2)) AS total_revenue,
              coalesce(q, 0) AS avg_quantity_per_order, coalesce(rn, 0) AS total_returns,
              CAST(CASE WHEN n > 0 THEN ((2000 * coalesce(rn, 0) + n) // (2 * n)) / 10.0
                        ELSE 0 END AS DECIMAL(18,1)) AS return_rate_pct
       FROM products p
       LEFT JOIN (SELECT product_id, count(order_id) AS n, sum(line_total) AS s,
                         CAST(sum(quantity) AS DOUBLE) / count(*) AS q
                  FROM fct_orders GROUP BY 1) o ON o.product_id = p.product_id
       LEFT JOIN (SELECT product_id, count(return_id) AS rn FROM fct_returns GROUP BY 1) r
         ON r.product_id = p.product_id""",
)
def product_performance(d: Domain):
    products = d.products.select("product_id", "product_name", "category", "unit_price")
    return gold.product_performance(d.fct_orders, d.fct_returns, products)


@query(
    "customer_rfm_90d",
    """WITH m AS (
         SELECT customer_id, max(order_ts) AS last_at,
                count(*) FILTER (order_ts >= t - INTERVAL 90 DAY) AS n,
                coalesce(sum(line_total) FILTER (order_ts >= t - INTERVAL 90 DAY), 0) AS s
         FROM fct_orders, as_of GROUP BY 1),
       a AS (
         SELECT *, CASE WHEN n = 0 THEN 0 ELSE (2 * CAST(s * 100 AS HUGEINT) + n) // (2 * n) END AS avg_cents
         FROM m)
       SELECT c.customer_id, c.region, c.segment, last_at AS last_order_at,
              coalesce(n, 0) AS order_count_90d,
              CAST(coalesce(s, 0) AS DECIMAL(28,2)) AS total_spend_90d,
              CAST(date_diff('day', CAST(last_at AS DATE), CAST((SELECT t FROM as_of) AS DATE)) AS INTEGER)
                AS days_since_last_order,
              CAST(coalesce(avg_cents, 0) / 100.0 AS DECIMAL(28,2)) AS avg_order_value_90d,
              CAST(coalesce(avg_cents * n * 4, 0) / 100.0 AS DECIMAL(28,2)) AS clv_estimate
       FROM customers c LEFT JOIN a ON a.customer_id = c.customer_id""",
)
def customer_rfm_90d(d: Domain):
    return gold.customer_rfm_90d(
        d.fct_orders, d.customers.select("customer_id", "region", "segment"), d.as_of
    )


@query("product_trend_7d", "SELECT * FROM product_trend")
def product_trend_7d(d: Domain):
    return trend(d)


@query(
    "trending_products",
    """(SELECT 'rising' AS direction, product_id, trend_score, gmv_7d, gmv_prior_7d
        FROM product_trend WHERE trend_score > 0 ORDER BY trend_score DESC, product_id LIMIT 10)
       UNION ALL
       (SELECT 'declining', product_id, trend_score, gmv_7d, gmv_prior_7d
        FROM product_trend WHERE trend_score < 0 ORDER BY trend_score, product_id LIMIT 10)""",
)
def trending_products(d: Domain):
    return gold.trending_products(trend(d), 10)


@query(
    "revenue_date_cat_region",
    """SELECT CAST(order_ts AS DATE) AS order_date, product_category, region,
              CAST(sum(line_total) AS DECIMAL(28,2)) AS total_revenue, count(order_id) AS order_count,
              CAST(((2 * CAST(sum(line_total) * 100 AS HUGEINT) + count(*)) // (2 * count(*))) / 100.0
                   AS DECIMAL(28,2)) AS avg_order_value
       FROM placed_orders GROUP BY 1, 2, 3""",
)
def revenue_date_cat_region(d: Domain):
    return gold.revenue_by(d.placed_orders, "order_date", "product_category", "region")


@query(
    "daily_region_revenue",
    """SELECT date_trunc('day', order_ts) AS window_start, region,
              CAST(sum(line_total) AS DECIMAL(28,2)) AS daily_revenue
       FROM placed_orders GROUP BY 1, 2""",
)
def daily_region_revenue(d: Domain):
    return gold.windowed_revenue(d.placed_orders, "order_ts", "region", "line_total")


@query(
    "last_week_revenue",
    """SELECT region, product_category, CAST(sum(line_total) AS DECIMAL(28,2)) AS total_revenue,
              count(*) AS order_count
       FROM placed_orders, as_of WHERE order_ts >= t - INTERVAL 7 DAY AND order_ts < t
       GROUP BY 1, 2""",
)
def last_week_revenue(d: Domain):
    return gold.revenue_last_days(d.placed(d.recent_orders(7)), d.as_of, "region", "product_category")


@query(
    "segment_churn_risk",
    """WITH s AS (
         SELECT segment, count(*) AS customers,
                count(*) FILTER (days_since_last_order IS NULL OR days_since_last_order > 90) AS at_risk
         FROM customer_metrics GROUP BY 1)
       SELECT *, CAST(((2000 * at_risk + customers) // (2 * customers)) / 10.0 AS DECIMAL(18,1)) AS at_risk_pct
       FROM s""",
)
def segment_churn_risk(d: Domain):
    recency = d.customers.select("customer_id", "segment").join(
        gold.order_metrics(d.fct_orders, d.as_of), "customer_id", "left"
    )
    return gold.segment_churn_risk(recency)


@query(
    "incremental_revenue",
    """SELECT CAST(order_ts AS DATE) AS order_date, product_id,
              CAST(sum(CAST(quantity * (unit_price + (CASE WHEN quantity % 7 = 0 THEN 1 ELSE 0 END))
                       AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue, count(*) AS lines
       FROM (SELECT * FROM fct_orders
             QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id, product_id, quantity,
                                        unit_price, line_total, order_ts) = 1)
       WHERE quantity % 11 <> 0 GROUP BY 1, 2""",
)
def incremental_revenue(d: Domain):
    """Totals kept up to date from the feed that a merge leaves equal a full recompute.

    The merge reprices lines (quantity divisible by 7) and cancels lines (divisible by
    11); only the months in its log are rewritten.
    """
    lines = first_per_key(d.fct_orders, ["order_id"])
    before = lines.select("order_id", "product_id", day(F.col("order_ts")).alias("order_date"), "quantity", "unit_price", "line_total")
    table = ChangeTable(d.spark, d.scratch("order_lines"), "order_id")
    table.write(before, V1_DATE)
    dimensions = ["order_date", "product_id"]
    totals = TotalsTable(d.scratch("line_totals"), dimensions, ["revenue", "lines"], F.trunc("order_date", "month"))
    totals.upsert(changes.signed_totals(table.changes(until=0), dimensions, "line_total"), 0)
    state = table.as_of()
    raised = state.withColumn("unit_price", (F.col("unit_price") + 1).cast("decimal(12,2)"))
    repriced = raised.filter("quantity % 7 = 0 AND quantity % 11 <> 0").withColumn(
        "line_total", (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)"))
    cancelled = state.filter("quantity % 11 = 0")
    table.merge(repriced, V2_DATE, delete=cancelled.select("order_id"))
    totals.upsert(changes.signed_totals(table.changes(since=1), dimensions, "line_total"), 1)
    return totals.read(d.spark).filter("lines <> 0")


@query(
    "revenue_enriched",
    """SELECT CAST(order_ts AS DATE) AS order_date, segment, brand,
              CAST(sum(line_total) AS DECIMAL(28,2)) AS total_revenue, count(order_id) AS order_count
       FROM fct_orders o JOIN customers c ON o.customer_id = c.customer_id
       JOIN products p ON o.product_id = p.product_id GROUP BY 1, 2, 3""",
)
def revenue_enriched(d: Domain):
    return gold.revenue_enriched(d.fct_orders, d.customers, d.products)


@query(
    "top_customers",
    """SELECT customer_id, total_orders, total_spend, days_since_last_order FROM customer_metrics
       ORDER BY total_spend DESC, customer_id LIMIT 10""",
)
def top_customers(d: Domain):
    columns = ["customer_id", "total_orders", "total_spend", "days_since_last_order"]
    return gold.top(metrics(d).select(*columns), "total_spend", 10, "customer_id")


@query("latest_days", "SELECT * FROM daily_revenue ORDER BY order_date DESC LIMIT 7")
def latest_days(d: Domain):
    return gold.top(gold.revenue_daily(d.fct_orders, d.fct_returns), "order_date", 7)


