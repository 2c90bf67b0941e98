"""Join queries: enrichment, key checks, point-in-time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import total
from tidemark.functions.times import day
from tidemark.operators import enrich, gold, history, keys, temporal
from tidemark.plans.domain import CARRIED, TRACKED, V1_DATE, Domain
from tidemark.plans.ingest import CATEGORY_SQL, category_rows
from tidemark.plans.registry import query
from tidemark.sinks import tables, versions
from tidemark.sources.files import load_categories, load_regions


@query(
    "left_join_metrics",
    """SELECT c.customer_id, o.n AS order_lines, r.n AS return_lines
       FROM customers c
       LEFT JOIN (SELECT customer_id, count(*) AS n FROM fct_orders GROUP BY 1) o
         ON o.customer_id = c.customer_id
       LEFT JOIN (SELECT customer_id, count(*) AS n FROM fct_returns GROUP BY 1) r
         ON r.customer_id = c.customer_id""",
)
def left_join_metrics(d: Domain):
    """Every customer with its counts; no rows on a side stays NULL.

    The facts are catalog tables in buckets of the customer: they are counted without a shuffle.
    """
    orders = d.catalog_table("orders-by-customer", lambda: d.fct_orders.select("order_id", "customer_id"), "customer_id")
    returns = d.catalog_table("returns-by-customer", lambda: d.fct_returns.select("return_id", "customer_id"), "customer_id")
    counted = [
        rows.groupBy("customer_id").agg(F.count(F.lit(1)).alias(name))
        for rows, name in ((orders, "order_lines"), (returns, "return_lines"))
    ]
    result = d.customers.select("customer_id")
    for side in counted:
        result = result.join(side, "customer_id", "left")
    return result


@query(
    "orders_refunds_join",
    "SELECT order_date, gross_revenue, nullif(total_refunds, 0) AS total_refunds FROM daily_revenue",
)
def orders_refunds_join(d: Domain):
    return (
        gold.daily_orders(d.fct_orders)
        .join(gold.daily_refunds(d.fct_returns), "order_date", "left")
        .select("order_date", "gross_revenue", "total_refunds")
    )


@query(
    "anti_join_new",
    """SELECT customer_id, email, city FROM customers_v2
       WHERE customer_id NOT IN (SELECT customer_id FROM customers_v1)""",
)
def anti_join_new(d: Domain):
    dim = history.scd2_apply(None, d.customers_v1, "customer_id", TRACKED, CARRIED, V1_DATE)
    fresh = enrich.new_rows(d.customers_v2, history.current_rows(dim), "customer_id")
    return fresh.select("customer_id", "email", "city")


_REGIONAL = """
    SELECT CAST(order_ts AS DATE) AS order_date, region, CAST(sum(line_total) AS DECIMAL(28,2)) AS total_revenue
    FROM placed_orders GROUP BY 1, 2"""


@query(
    "enriched_revenue",
    f"""SELECT v.*, region_name, country, timezone FROM ({_REGIONAL}) v
        LEFT JOIN regions ON region = region_code""",
)
def enriched_revenue(d: Domain):
    """Regional daily revenue with the attributes of a small reference file."""
    path = d.scratch("regions_csv")
    tables.export_csv(d.regions, path)
    revenue = (
        d.placed_orders.withColumn("order_date", day(F.col("order_ts")))
        .groupBy("order_date", "region")
        .agg(total("line_total").alias("total_revenue"))
    )
    return enrich.enriched_revenue(revenue, load_regions(d.spark, path))


@query(
    "broadcast_two_dims",
    """SELECT o.order_id, o.line_total, c.city, c.segment, r.region_name
       FROM placed_orders o LEFT JOIN regions r ON o.region = r.region_code
       LEFT JOIN dim_customers c ON c.customer_id = o.customer_id AND c.is_current""",
)
def broadcast_two_dims(d: Domain):
    """Order lines with region and current customer; each side is measured before a broadcast."""
    current = history.current_rows(d.dim_customers).select("customer_id", "city", "segment")
    return enrich.with_two_dimensions(
        d.placed_orders.withColumnRenamed("region", "region_code"),
        d.regions.select("region_code", "region_name"),
        current,
        ["order_id", "line_total", "city", "segment", "region_name"],
    )


@query(
    "composite_key_join",
    f"""SELECT p.product_id, p.category, p.brand AS sub_category, display_name, is_seasonal, margin_band
        FROM products p LEFT JOIN ({CATEGORY_SQL}) c
        ON p.category = c.category AND p.brand = c.sub_category""",
)
def composite_key_join(d: Domain):
    path = d.scratch("categories_csv")
    tables.export_csv(category_rows(d), path)
    products = d.products.select("product_id", "category", F.col("brand").alias("sub_category"))
    return enrich.with_category(products, load_categories(d.spark, path))


def order_facts(d: Domain):
    """What the temporal joins read of the facts."""
    return d.fct_orders.select("order_id", "customer_id", "order_ts", "line_total")


@query(
    "point_in_time_join",
    """SELECT o.order_id, o.customer_id, o.order_ts, o.line_total, c.city, c.segment
       FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
        AND o.order_ts >= c.valid_from AND o.order_ts < c.valid_to""",
)
def point_in_time_join(d: Domain):
    """City and segment as they were at order time."""
    facts = order_facts(d)
    return temporal.point_in_time(facts, d.dim_customers, "customer_id", "order_ts", ["city", "segment"])


@query(
    "pit_join_closed",
    """SELECT o.order_id, o.order_ts, o.line_total, c.city, c.country, c.is_current
       FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
        AND o.order_ts BETWEEN c.valid_from AND c.valid_to""",
)
def pit_join_closed(d: Domain):
    """The closed form: an order on a boundary meets both versions."""
    facts = order_facts(d)
    joined = temporal.point_in_time(
        facts, d.dim_customers, "customer_id", "order_ts", ["city", "country", "is_current"], closed=True
    )
    return joined.drop("customer_id")


_OVERLAPPING = """
    SELECT customer_id, city, valid_from, valid_to FROM dim_customers
    UNION ALL SELECT customer_id, 'TEMPORARY', TIMESTAMP '1994-07-01', TIMESTAMP '1996-02-01' FROM customers_v1
    WHERE right(customer_id, 1) = '3'
    UNION ALL SELECT customer_id, 'EXTRA', TIMESTAMP '1996-01-01', NULL FROM customers_v1 WHERE right(customer_id, 1) = '3'"""


@query(
    "overlapping_history_join",
    f"""SELECT o.order_id, o.order_ts, c.city, closed FROM fct_orders o
        JOIN (SELECT *, unnest([false, true]) AS closed FROM ({_OVERLAPPING})) c ON o.customer_id = c.customer_id
         AND o.order_ts >= valid_from AND (valid_to IS NULL OR o.order_ts < valid_to OR closed AND o.order_ts = valid_to)""",
)
def overlapping_history_join(d: Domain):
    """Orders with every address valid at their time, where some customers have several, in both forms."""
    some = d.customers_v1.filter(F.col("customer_id").endswith("3"))
    spans = [("TEMPORARY", "1994-07-01", "1996-02-01"), ("EXTRA", "1996-01-01", None)]
    history = d.dim_customers.select("customer_id", "city", "valid_from", "valid_to")
    for city, start, end in spans:
        history = history.unionByName(some.select(
            "customer_id", F.lit(city).alias("city"), F.lit(start).cast("timestamp_ntz").alias("valid_from"),
            F.lit(end).cast("timestamp_ntz").alias("valid_to")))
    facts = d.fct_orders.select("order_id", "customer_id", "order_ts")
    forms = [
        temporal.point_in_time_overlapping(facts, history, "customer_id", "order_ts", ["city"], closed=closed)
        .withColumn("closed", F.lit(closed)) for closed in (False, True)
    ]
    return forms[0].unionByName(forms[1]).drop("customer_id")


@query(
    "snapshot_as_of_join",
    """SELECT o.order_id, o.line_total, c.city AS city_then
       FROM fct_orders o JOIN customers_v1 c ON o.customer_id = c.customer_id""",
)
def snapshot_as_of_join(d: Domain):
    """Today's facts with the dimension as it stood before its second load."""
    path = d.scratch("customer_versions")
    first = history.scd2_apply(None, d.customers_v1, "customer_id", TRACKED, CARRIED, V1_DATE)
    versions.commit(first, path, "WRITE", V1_DATE)
    versions.commit(d.dim_customers, path, "MERGE", "1998-01-01 00:00:00")
    then = versions.as_of_version(d.spark, path, ts="1997-12-02 00:00:00")
    facts = d.fct_orders.select("order_id", "customer_id", "line_total")
    joined = temporal.snapshot_as_of_join(facts, then, "customer_id", ["city"])
    return joined.select("order_id", "line_total", F.col("city").alias("city_then"))


@query(
    "fk_semi_join",
    """SELECT order_id, customer_id, product_id, quantity FROM checked_orders
       WHERE customer_known AND product_known""",
)
def fk_semi_join(d: Domain):
    kept = enrich.known_facts(d.orders_raw, d.customers, d.products)
    return kept.select("order_id", "customer_id", "product_id", "quantity")


@query(
    "fk_orphans",
    """SELECT 'orders.customer_id' AS foreign_key, customer_id AS key_value, count(*) AS row_count
       FROM orders_raw WHERE customer_id NOT IN (SELECT customer_id FROM customers) GROUP BY 2
       UNION ALL
       SELECT 'returns.order_id', order_id, count(*)
       FROM returns_raw WHERE order_id NOT IN (SELECT order_id FROM fct_orders) GROUP BY 2
       UNION ALL
       SELECT 'orders.product_id', product_id, count(*)
       FROM orders_raw WHERE product_id NOT IN (SELECT product_id FROM products) GROUP BY 2
       UNION ALL
       SELECT 'returns.customer_id', customer_id, count(*)
       FROM returns_raw WHERE customer_id NOT IN (SELECT customer_id FROM customers) GROUP BY 2
       UNION ALL
       SELECT 'returns.product_id', product_id, count(*)
       FROM returns_raw WHERE product_id NOT IN (SELECT product_id FROM products) GROUP BY 2
       UNION ALL
       SELECT 'customers.region', region, count(*)
       FROM customers WHERE region NOT IN (SELECT region_code FROM regions) GROUP BY 2""",
)
def fk_orphans(d: Domain):
    """Child keys without parent, for every foreign key of the facts (the region through the customer)."""
    regions = d.regions.select(F.col("region_code").alias("region"))
    checks = [
        ("orders.customer_id", d.orders_raw, d.customer_keys, "customer_id"),
        ("returns.order_id", d.returns_raw, d.fct_orders, "order_id"),
        ("orders.product_id", d.orders_raw, d.products, "product_id"),
        ("returns.customer_id", d.returns_raw, d.customer_keys, "customer_id"),
        ("returns.product_id", d.returns_raw, d.products, "product_id"),
        ("customers.region", d.customers, regions, "region"),
    ]
    reports = [
        keys.fk_orphans(child, parent, key).select(
            F.lit(name).alias("foreign_key"), F.col(key).alias("key_value"), "row_count"
        )
        for name, child, parent, key in checks
    ]
    return reduce(DataFrame.unionByName, reports)


@query(
    "revenue_by_category",
    """SELECT sha256(p.category) AS category_id, p.category AS category_name,
              CAST(sum(line_total) AS DECIMAL(28,2)) AS revenue
       FROM fct_orders o JOIN products p ON o.product_id = p.product_id GROUP BY 1, 2""",
)
def revenue_by_category(d: Domain):
    products = d.products.withColumn("category_id", F.sha2("category", 256))
    categories = products.select("category_id", F.col("category").alias("category_name")).distinct()
    return gold.revenue_by_category(d.fct_orders, products, categories)


@query(
    "join_fanout_check",
    """WITH dims AS (SELECT product_id FROM products_v1 UNION ALL SELECT product_id FROM products_v2),
            d AS (SELECT product_id, count(*) AS n FROM dims GROUP BY 1)
       SELECT count(*) AS fact_rows,
              CAST(sum(greatest(coalesce(n, 0), 1)) AS DECIMAL(38,0)) AS joined_rows,
              count(DISTINCT CASE WHEN n > 1 THEN d.product_id END) AS duplicated_keys,
              sum(greatest(coalesce(n, 0), 1)) > count(*) AS fans_out
       FROM fct_orders o LEFT JOIN d ON o.product_id = d.product_id""",
)
def join_fanout_check(d: Domain):
    """A dimension holding two loads of each product multiplies facts; shown from counts."""
    dims = d.products_v1.select("product_id").unionByName(d.products_v2.select("product_id"))
    return keys.join_fanout(d.fct_orders, dims, "product_id")
