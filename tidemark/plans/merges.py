"""Merge, history and deduplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import row_hash
from tidemark.operators import history, keys, merge
from tidemark.plans.domain import CARRIED, PRODUCT_COLUMNS, TRACKED, V1_DATE, V2_DATE, Domain
from tidemark.plans.ingest import change_log
from tidemark.plans.registry import query
from tidemark.sinks import tables

_SCD1 = """
    SELECT product_id, product_name, category, unit_price, supplier_id,
           TIMESTAMP '1998-01-01' AS _last_updated FROM products_v2
    UNION ALL
    SELECT product_id, product_name, category, unit_price, supplier_id, TIMESTAMP '1995-01-01'
    FROM products_v1 WHERE product_id NOT IN (SELECT product_id FROM products_v2)"""


@query(
    "latest_per_key",
    """SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_quantity FROM (
         SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC,
                  l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def latest_per_key(d: Domain):
    """The last shipped line of every part."""
    lines = d.table("lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    return keys.latest_per_key(lines, ["l_partkey"], ["l_shipdate"])


@query(
    "dedup_orders",
    """SELECT order_id, customer_id, product_id, quantity, unit_price, line_total, order_ts FROM (
         SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY customer_id, product_id, quantity,
                unit_price, line_total, order_ts) AS rn FROM fct_orders) WHERE rn = 1""",
)
def dedup_orders(d: Domain):
    return keys.first_per_key(d.fct_orders, ["order_id"])


def product_dim(d: Domain):
    return merge.scd1_upsert(None, d.products_v1, "product_id", PRODUCT_COLUMNS, V1_DATE)


@query("scd1_upsert", _SCD1)
def scd1_upsert(d: Domain):
    return merge.scd1_upsert(product_dim(d), d.products_v2, "product_id", PRODUCT_COLUMNS, V2_DATE)


@query("staged_upsert", _SCD1)
def staged_upsert(d: Domain):
    """The staged form: rows without key dropped, count asserted, then merged."""
    nameless = d.products_v2.withColumn("product_id", F.lit(None).cast("string"))
    return merge.staged_upsert(
        product_dim(d), d.products_v2.unionByName(nameless), "product_id", PRODUCT_COLUMNS, 100, V2_DATE
    )


@query("scd2_apply", "SELECT * FROM dim_customers")
def scd2_apply(d: Domain):
    return d.dim_customers


@query(
    "apply_changes_scd2",
    """WITH log AS (
         SELECT *, TIMESTAMP '1995-01-01' AS seq FROM customers_v1
         UNION ALL SELECT *, TIMESTAMP '1998-01-01' FROM customers_v2),
       changed AS (
         SELECT *, lag(customer_id) OVER w IS NOT NULL
                AND email IS NOT DISTINCT FROM lag(email) OVER w
                AND city IS NOT DISTINCT FROM lag(city) OVER w
                AND country IS NOT DISTINCT FROM lag(country) OVER w
                AND phone IS NOT DISTINCT FROM lag(phone) OVER w AS same
         FROM log WINDOW w AS (PARTITION BY customer_id ORDER BY seq)),
       versions AS (
         SELECT *, lead(seq) OVER (PARTITION BY customer_id ORDER BY seq) AS next_seq
         FROM changed WHERE NOT same),
       gone AS (SELECT customer_id FROM customers_v1
                WHERE customer_id NOT IN (SELECT customer_id FROM customers_v2))
       SELECT customer_id, email, city, country, phone,
              next_seq IS NULL AND customer_id NOT IN (FROM gone) AS is_current, seq AS valid_from,
              coalesce(next_seq, CASE WHEN customer_id IN (FROM gone) THEN TIMESTAMP '1998-01-01' END,
                       TIMESTAMP '9999-12-31') AS valid_to
       FROM versions""",
)
def apply_changes_scd2(d: Domain):
    """History rebuilt from the change log, including repeats and deletes."""
    log = change_log(d)
    return history.apply_changes_scd2(log.unionByName(log), "customer_id", "seq", TRACKED)


@query(
    "conditional_update",
    """SELECT v.customer_id, v.city, NOT c.changed AS is_current,
              CASE WHEN c.changed THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '9999-12-31' END AS valid_to
       FROM customers_v1 v JOIN customer_changes c ON v.customer_id = c.old_id""",
)
def conditional_update(d: Domain):
    """Expire only those current rows whose hash changed."""
    dim = history.scd2_apply(None, d.customers_v1, "customer_id", TRACKED, CARRIED, V1_DATE)
    source = d.customers_v2.withColumn("row_hash", row_hash(TRACKED))
    expired = merge.conditional_update(
        dim,
        source,
        "customer_id",
        F.col("t.row_hash") != F.col("s.row_hash"),
        {"is_current": F.lit(False), "valid_to": F.lit(V2_DATE).cast("timestamp_ntz")},
    )
    return expired.select("customer_id", "city", "is_current", "valid_to")


@query("truncate_load", "SELECT * FROM regions")
def truncate_load(d: Domain):
    """Guarded full replacement of the region table."""
    return tables.overwrite_table(merge.truncate_load(d.regions, min_rows=9), d.scratch("regions"))


@query(
    "append_dedup",
    """WITH old AS (SELECT * FROM fct_orders WHERE order_ts < TIMESTAMP '1998-01-01'),
            fresh AS (SELECT * FROM fct_orders WHERE order_id NOT IN (SELECT order_id FROM old))
       SELECT order_id, product_id, line_total, order_ts FROM old
       UNION ALL
       SELECT order_id, product_id, line_total, order_ts FROM (
         SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY product_id, line_total, order_ts) AS rn
         FROM fresh) WHERE rn = 1""",
)
def append_dedup(d: Domain):
    """A redelivery of all order lines onto the lines before 1998."""
    lines = d.fct_orders.select("order_id", "product_id", "line_total", "order_ts")
    old = lines.filter("order_ts < timestamp_ntz'1998-01-01'")
    return keys.append_dedup(old, lines, "order_id")
