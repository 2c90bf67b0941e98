"""Projection, filter and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.money import line_total, percent
from tidemark.functions.text import masked_email, normalised, row_hash
from tidemark.functions.times import day, parse_timestamp
from tidemark.operators import gold, history, layout, validation
from tidemark.plans.domain import Domain, padded
from tidemark.plans.registry import query
from tidemark.sinks.tables import shared_view


@query(
    "line_total",
    """SELECT order_id, product_id, quantity, unit_price,
              CAST(quantity * unit_price AS DECIMAL(18,2)) AS line_total FROM orders_raw""",
)
def line_totals(d: Domain):
    return d.orders_raw.select(
        "order_id", "product_id", "quantity", "unit_price",
        line_total("quantity", "unit_price").alias("line_total"),
    )


@query(
    "expand_struct",
    """SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
       FROM events""",
)
def expand_struct(d: Domain):
    """JSON text to a struct, flattened into columns."""
    parsed = d.table("events").withColumn("_p", F.from_json("props", "k INT"))
    return parsed.select("event_id", "user_id", "event_type", "_p.*")


@query(
    "casts",
    """SELECT event_id, event_type AS text_from_binary, CAST(ts AS DATE) AS event_date,
              event_type = 'click' AS is_click,
              CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS value_text,
              CAST(value AS DECIMAL(12,2)) AS value_decimal, CAST(NULL AS INTEGER) AS bad_int
       FROM events""",
)
def casts(d: Domain):
    return d.table("events").select(
        "event_id",
        F.col("event_type").cast("binary").cast("string").alias("text_from_binary"),
        F.col("ts").cast("date").alias("event_date"),
        F.when(F.col("event_type") == "click", "true").otherwise("false").cast("boolean").alias("is_click"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("value_text"),
        F.col("value").cast("string").try_cast("decimal(12,2)").alias("value_decimal"),
        F.col("event_type").try_cast("int").alias("bad_int"),
    )


@query(
    "fill_missing",
    """SELECT order_id, customer_id, coalesce(unit_price, 0) AS unit_price,
              coalesce(CAST(quantity * unit_price AS DECIMAL(18,2)), 0) AS line_total
       FROM orders_raw""",
)
def fill_missing(d: Domain):
    """Zero for missing numbers; missing text stays missing."""
    rows = d.orders_raw.select(
        "order_id", "customer_id", "unit_price",
        line_total("quantity", "unit_price").alias("line_total"),
    )
    return rows.fillna(0, subset=["unit_price"]).fillna(0)


@query(
    "normalise_text",
    """SELECT customer_id, lower(trim(' ' || c_mktsegment || ' ')) AS segment,
              lower(trim(c_name)) AS name_key,
              CAST(c_acctbal AS DECIMAL(12,2)) AS balance
       FROM customer JOIN customer_rows USING (c_custkey)""",
)
def normalise_text(d: Domain):
    return d.table("customer").select(
        padded("C", "c_custkey", 6).alias("customer_id"),
        normalised(F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))).alias("segment"),
        normalised("c_name").alias("name_key"),
        F.col("c_acctbal").cast("string").try_cast("decimal(12,2)").alias("balance"),
    )


@query(
    "masked_customers",
    """SELECT customer_id, sha256(first_name) AS first_name, CAST(NULL AS VARCHAR) AS last_name,
              regexp_replace(email, '^(.)[^@]*@', '\\1***@') AS email, region, segment
       FROM customers""",
)
def masked_customers(d: Domain):
    """Personal fields hashed, shortened or removed."""
    return d.customers.select(
        "customer_id",
        F.sha2("first_name", 256).alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        masked_email("email").alias("email"),
        "region",
        "segment",
    )


@query("shared_revenue", "SELECT order_date, net_revenue FROM daily_revenue")
def shared_revenue(d: Domain):
    return shared_view(gold.revenue_daily(d.fct_orders, d.fct_returns), ["order_date", "net_revenue"])


@query(
    "current_customers",
    "SELECT customer_id, city, valid_from FROM dim_customers WHERE is_current",
)
def current_customers(d: Domain):
    return history.current_rows(d.dim_customers).select("customer_id", "city", "valid_from")


@query("valid_orders", "SELECT * FROM fct_orders")
def valid_orders(d: Domain):
    return d.fct_orders


@query("valid_returns", "SELECT * FROM fct_returns")
def valid_returns(d: Domain):
    return d.fct_returns


@query(
    "fk_membership",
    """SELECT order_id, customer_id, product_id, customer_known AS known_customer,
              product_known AS known_product FROM checked_orders""",
)
def fk_membership(d: Domain):
    """Both key checks as flags, with the key sets kept distributed."""
    known = validation.mark_known(d.orders_raw, d.customers, "customer_id", "known_customer")
    known = validation.mark_known(known, d.products, "product_id", "known_product")
    return known.select("order_id", "customer_id", "product_id", "known_customer", "known_product")


@query(
    "key_time_lookup",
    """SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(12,2)) AS amount
       FROM orders WHERE o_custkey = 42 AND o_orderdate > TIMESTAMP '1996-01-01'""",
)
def key_time_lookup(d: Domain):
    """One customer's later orders; both conditions reach the scan."""
    return (
        d.table("orders")
        .filter((F.col("o_custkey") == 42) & (F.col("o_orderdate") > F.lit("1996-01-01").cast("timestamp_ntz")))
        .select("o_orderkey", "o_custkey", "o_orderdate", F.col("o_totalprice").cast("decimal(12,2)").alias("amount"))
    )


@query(
    "bloom_lookup",
    """SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(12,2)) AS amount
       FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)""",
)
def bloom_lookup(d: Domain):
    """One order in a table sorted by customer and time: its key is found by the row groups' Bloom filters."""
    orders = d.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    table = layout.write_lookup(orders, d.scratch("orders_lookup"), ["o_orderkey"], ["o_custkey", "o_orderdate"], 0.25)
    key = orders.agg(F.max("o_orderkey")).first()[0]
    return table.filter(F.col("o_orderkey") == key).select(
        "o_orderkey", "o_custkey", "o_orderdate", F.col("o_totalprice").cast("decimal(12,2)").alias("amount"))


@query(
    "scd2_history",
    """SELECT customer_id, city, is_current, valid_from, valid_to FROM dim_customers
       WHERE customer_id = 'C000030' ORDER BY valid_from""",
)
def scd2_history(d: Domain):
    return history.scd2_history(d.dim_customers, "customer_id", "C000030").select(
        "customer_id", "city", "is_current", "valid_from", "valid_to"
    )


@query(
    "scalar_dates",
    """SELECT o_orderkey, CAST(date_trunc('day', o_orderdate) AS DATE) AS order_day,
              CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT t FROM as_of) AS DATE)) AS INTEGER) AS age_days,
              try_strptime(CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
                                ELSE o_orderstatus END, '%Y-%m-%dT%H:%M:%S') AS parsed_ts,
              o_orderdate - INTERVAL 30 DAY AS month_before
       FROM orders""",
)
def scalar_dates(d: Domain):
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.col("o_orderstatus")
    )
    return d.table("orders").select(
        "o_orderkey",
        day(F.col("o_orderdate")).alias("order_day"),
        F.datediff(d.as_of.cast("date"), F.col("o_orderdate").cast("date")).alias("age_days"),
        parse_timestamp(text).alias("parsed_ts"),
        (F.col("o_orderdate") - F.expr("INTERVAL 30 DAYS")).alias("month_before"),
    )


@query(
    "scalar_hash",
    """SELECT customer_id, sha256(concat_ws('|', email, city, country, phone)) AS row_hash
       FROM customers""",
)
def scalar_hash(d: Domain):
    return d.customers.select("customer_id", row_hash(["email", "city", "country", "phone"]).alias("row_hash"))


@query(
    "scalar_json",
    """SELECT event_id,
              CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL
                   ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
       FROM events""",
)
def scalar_json(d: Domain):
    """Garbage text and wrong-typed fields both parse to NULL."""
    text = (
        F.when(F.col("event_id") % 97 == 0, F.lit("garbage"))
        .when(F.col("event_id") % 89 == 0, F.lit('{"k": "many"}'))
        .otherwise(F.col("props"))
    )
    return d.table("events").select("event_id", F.from_json(text, "k INT")["k"].alias("k"))


@query(
    "scalar_conditional",
    """SELECT p.product_id, coalesce(p.supplier_id, 'unknown') AS supplier,
              CASE WHEN p.unit_price >= 1500 THEN 'high' WHEN p.unit_price >= 1000 THEN 'mid' ELSE 'low' END AS band,
              CAST(CASE WHEN n > 0 THEN ((2000 * r + n) // (2 * n)) / 10.0 ELSE 0 END AS DECIMAL(18,1)) AS returned_pct
       FROM products p JOIN (
         SELECT l_partkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS r
         FROM lineitem GROUP BY 1) s ON p.product_id =
           'P' || lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(5, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0')""",
)
def scalar_conditional(d: Domain):
    lines = (
        d.table("lineitem")
        .groupBy("l_partkey")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
        .select(padded("P", "l_partkey", 5).alias("product_id"), "n", "r")
    )
    price = F.col("unit_price")
    return d.products.join(lines, "product_id").select(
        "product_id",
        F.coalesce("supplier_id", F.lit("unknown")).alias("supplier"),
        F.when(price >= 1500, "high").when(price >= 1000, "mid").otherwise("low").alias("band"),
        percent("r", "n").alias("returned_pct"),
    )


