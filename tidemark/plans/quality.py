"""Validation, quarantine and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.money import line_total, total
from tidemark.functions.times import open_end
from tidemark.operators import gold, history, keys, temporal, validation
from tidemark.plans.domain import Domain
from tidemark.plans.joins import order_facts
from tidemark.plans.registry import query
from tidemark.sinks import tables

STATUSES = ("F", "O")


@query(
    "fct_orders",
    """SELECT order_id, customer_id, product_id, quantity, unit_price, order_ts, ok,
              CASE WHEN ok THEN CAST(quantity * unit_price AS DECIMAL(18,2)) END AS line_total
       FROM flagged_orders""",
)
def fct_orders(d: Domain):
    """Good and quarantined rows, split by one write of the flagged table."""
    table = tables.write_validated(d.flagged_orders, d.scratch("orders_validated"))
    return table.select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "order_ts",
        F.col("_ok").cast("boolean").alias("ok"),
        F.when(F.col("_ok").cast("boolean"), line_total("quantity", "unit_price")).alias("line_total"),
    )


@query(
    "fct_returns",
    "SELECT return_id, order_id, return_date, reason_code, refund_amount, ok FROM flagged_returns",
)
def fct_returns(d: Domain):
    """Good and quarantined returns, stored apart by one write of the flagged table."""
    table = tables.write_validated(d.flagged_returns, d.scratch("returns_validated"))
    return table.select(
        "return_id", "order_id", "return_date", "reason_code", "refund_amount", F.col("_ok").cast("boolean").alias("ok")
    )


@query(
    "quarantine_orders",
    """SELECT order_id, customer_id, product_id, quantity, unit_price, order_ts,
              'validation_failed' AS reason, TRUE AS stamped FROM flagged_orders WHERE NOT ok""",
)
def quarantine_orders(d: Domain):
    """Bad rows written with reason and load time, only because there are some."""
    path = d.scratch("orders_quarantine")
    bad = validation.bad_rows(d.flagged_orders)
    if not tables.write_quarantine(bad, path):
        raise RuntimeError("the raw orders hold defects; none were found")
    return d.spark.read.parquet(path).select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "order_ts",
        F.col("_quarantine_reason").alias("reason"),
        F.col("_loaded_at").isNotNull().alias("stamped"),
    )


def order_rules() -> dict:
    return {
        "amount_in_bounds": (F.col("o_totalprice") > 0) & (F.col("o_totalprice") < 400000),
        "status_known": F.col("o_orderstatus").isin(*STATUSES),
        "no_urgent_backlog": ~((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")),
    }


_RULES = """
    SELECT *, coalesce(o_totalprice > 0 AND o_totalprice < 400000, FALSE) AS r1,
           coalesce(o_orderstatus IN ('F', 'O'), FALSE) AS r2,
           coalesce(NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'), FALSE) AS r3
    FROM orders"""


@query(
    "dq_rules",
    " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER ({c}) AS passed, count(*) FILTER (NOT {c}) AS failed FROM ({_RULES})"
        for name, c in (("amount_in_bounds", "r1"), ("status_known", "r2"), ("no_urgent_backlog", "r3"))
    ),
)
def dq_rules(d: Domain):
    return validation.dq_report(d.table("orders"), order_rules())


@query("dq_drop", f"SELECT o_orderkey, o_orderstatus FROM ({_RULES}) WHERE r1 AND r2 AND r3")
def dq_drop(d: Domain):
    return validation.keep_valid(d.table("orders"), order_rules()).select("o_orderkey", "o_orderstatus")


@query(
    "dq_score",
    f"""SELECT count(*) AS total_rows, count(*) FILTER (r1 AND r2 AND r3) AS passing_rows,
               CAST(count(*) FILTER (r1 AND r2 AND r3) AS DOUBLE) / count(*) AS score FROM ({_RULES})""",
)
def dq_score(d: Domain):
    return validation.dq_score(d.table("orders"), order_rules())


@query(
    "row_count_guard",
    """SELECT count(*) AS row_count, CAST(1000 AS BIGINT) AS min_rows, count(*) >= 1000 AS passed
       FROM fct_orders""",
)
def row_count_guard(d: Domain):
    return validation.row_count_check(d.fct_orders, 1000)


@query(
    "duplicate_keys",
    "SELECT order_id, count(*) AS row_count FROM fct_orders GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_keys(d: Domain):
    return keys.duplicate_keys(d.fct_orders, "order_id")


@query(
    "scd2_integrity",
    """SELECT customer_id, CAST(2 AS BIGINT) AS current_rows, CAST(1 AS BIGINT) AS overlaps,
              CAST(0 AS BIGINT) AS gaps
       FROM customers_v1 JOIN customer_changes ON customer_id = old_id WHERE changed""",
)
def scd2_integrity(d: Domain):
    """The closure bug: changed customers whose old version was never closed."""
    unclosed = d.dim_customers.withColumns({"is_current": F.lit(True), "valid_to": open_end()})
    return history.scd2_integrity(unclosed, "customer_id")


@query(
    "pit_leakage_audit",
    """WITH f AS (SELECT customer_id, order_ts FROM fct_orders),
       p AS (SELECT count(*) AS n, count(*) FILTER (f.order_ts < c.valid_to) AS k
             FROM f JOIN dim_customers c
             ON f.customer_id = c.customer_id AND f.order_ts >= c.valid_from),
       u AS (SELECT count(*) AS n FROM f JOIN dim_customers c
             ON f.customer_id = c.customer_id AND c.is_current AND f.order_ts < c.valid_from)
       SELECT (SELECT count(*) FROM f) AS fact_rows, p.n AS lower_bound_rows, p.k AS correct_rows,
              u.n AS future_rows, p.n - p.k AS leaked_rows FROM p, u""",
)
def pit_leakage_audit(d: Domain):
    return temporal.leakage_audit(order_facts(d), d.dim_customers, "customer_id", "order_ts")


@query(
    "revenue_reconcile",
    """WITH r AS (SELECT category, sum(line_total) AS reported FROM fct_orders JOIN products USING (product_id) GROUP BY 1),
       w AS (SELECT category, sum(CAST(quantity * unit_price AS DECIMAL(18,2))) AS raw FROM (
               SELECT o.quantity, o.unit_price, p.category FROM orders_raw o
               JOIN products p ON o.product_id = p.product_id) GROUP BY 1)
       SELECT category, CAST(reported AS DECIMAL(28,2)) AS reported, CAST(raw AS DECIMAL(28,2)) AS raw,
              CAST(reported - raw AS DECIMAL(28,2)) AS difference, reported = raw AS matches
       FROM r FULL JOIN w USING (category)""",
)
def revenue_reconcile(d: Domain):
    """Category totals of the validated facts against those of the raw rows."""
    category = d.products.select("product_id", "category")
    raw = d.orders_raw.withColumn("line_total", line_total("quantity", "unit_price"))
    sides = [
        rows.groupBy("product_id").agg(total("line_total").alias("line_total")).join(category, "product_id")
        for rows in (d.fct_orders, raw)
    ]
    return gold.reconcile(*sides, "category", "line_total")


@query(
    "load_summary",
    """SELECT 'orders' AS load, count(*) AS total_rows, count(*) FILTER (ok) AS good_rows,
              count(*) FILTER (NOT ok) AS quarantined_rows FROM flagged_orders
       UNION ALL
       SELECT 'returns', count(*), count(*) FILTER (ok), count(*) FILTER (NOT ok) FROM flagged_returns""",
)
def load_summary(d: Domain):
    loads = {"orders": d.flagged_orders, "returns": d.flagged_returns}
    reports = [validation.load_summary(f).withColumn("load", F.lit(n)) for n, f in loads.items()]
    return reports[0].unionByName(reports[1])


@query(
    "failed_rules",
    """SELECT order_id, customer_id, product_id,
              concat_ws(',', CASE WHEN NOT order_id_present THEN 'order_id_present' END,
                             CASE WHEN NOT customer_known THEN 'customer_known' END,
                             CASE WHEN NOT product_known THEN 'product_known' END,
                             CASE WHEN NOT price_positive THEN 'price_positive' END,
                             CASE WHEN order_ts_parsed IS NULL THEN 'order_ts_valid' END) AS failed_rules
       FROM flagged_orders WHERE NOT ok""",
)
def failed_rules(d: Domain):
    return validation.bad_rows(d.flagged_orders).select(
        "order_id", "customer_id", "product_id", F.concat_ws(",", "_failed_rules").alias("failed_rules")
    )
