"""Snapshot, change-feed and layout queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import changes, layout
from tidemark.plans.domain import V1_DATE, V2_DATE, Domain
from tidemark.plans.registry import query
from tidemark.sinks import tables
from tidemark.sinks.changelog import ChangeTable

STATE = ["customer_id", "email", "city", "phone"]
DATES = ["2024-05-10 00:00:00", "2024-05-14 12:00:00", "2024-05-16 00:00:00"]

_FEED = """
    SELECT a.customer_id, a.email, a.city, a.phone,
           CASE WHEN b.customer_id IS NULL THEN 'delete' ELSE 'update_preimage' END AS change_type
    FROM customers_v1 a LEFT JOIN customers_v2 b ON a.customer_id = b.customer_id
    WHERE b.customer_id IS NULL OR a.email <> b.email OR a.city <> b.city
    UNION ALL
    SELECT b.customer_id, b.email, b.city, b.phone,
           CASE WHEN a.customer_id IS NULL THEN 'insert' ELSE 'update_postimage' END
    FROM customers_v2 b LEFT JOIN customers_v1 a ON a.customer_id = b.customer_id
    WHERE a.customer_id IS NULL OR a.email <> b.email OR a.city <> b.city"""


def customer_table(d: Domain) -> ChangeTable:
    """The customer table after its second load: a merge of the new rows and of the keys that left."""
    table = ChangeTable(d.spark, d.scratch("customer_changes"), "customer_id")
    table.write(d.customers_v1.select(*STATE), V1_DATE)
    gone = d.customers_v1.select("customer_id").join(d.customers_v2.select("customer_id"), "customer_id", "left_anti")
    table.merge(d.customers_v2.select(*STATE), V2_DATE, delete=gone)
    return table


@query("change_feed", _FEED)
def change_feed(d: Domain):
    """What the merge left in its log."""
    return customer_table(d).changes(since=1).select(*STATE, F.col("_change_type").alias("change_type"))


@query(
    "changes_since",
    f"""SELECT customer_id, city, change_type, TIMESTAMP '1998-01-01' AS committed_at
        FROM ({_FEED}) WHERE change_type IN ('insert', 'update_postimage')""",
)
def changes_since(d: Domain):
    """New and updated rows since a time: only the later versions' folders are read."""
    feed = customer_table(d).changes(ts="1996-05-01 00:00:00")
    return changes.changes_since(feed).select(
        "customer_id",
        "city",
        F.col("_change_type").alias("change_type"),
        F.col("_commit_timestamp").alias("committed_at"),
    )


def order_versions(d: Domain) -> ChangeTable:
    """Three versions of the order table: a first load, an append, a delete."""
    table = ChangeTable(d.spark, d.scratch("order_versions"), "order_id")
    lines = d.fct_orders.select("order_id", "customer_id", "line_total", "order_ts")
    table.write(lines.filter("order_ts < timestamp_ntz'1997-01-01'"), DATES[0])
    table.append(lines.filter("order_ts >= timestamp_ntz'1997-01-01'"), DATES[1])
    table.delete(F.col("order_ts") < F.lit("2000-01-01").cast("timestamp_ntz"), DATES[2])
    return table


@query(
    "as_of_version",
    """SELECT order_id, customer_id, line_total, order_ts, 0 AS version FROM fct_orders
       WHERE order_ts < TIMESTAMP '1997-01-01'
       UNION ALL SELECT order_id, customer_id, line_total, order_ts, 1 FROM fct_orders""",
)
def as_of_version(d: Domain):
    """Version 0 by number and version 1 by time."""
    table = order_versions(d)
    by_number = table.as_of(version=0).withColumn("version", F.lit(0))
    by_time = table.as_of(ts="2024-05-15 00:00:00").withColumn("version", F.lit(1))
    return by_number.unionByName(by_time)


@query(
    "version_history",
    """SELECT 0 AS version, TIMESTAMP '2024-05-10 00:00:00' AS committed_at, 'WRITE' AS operation,
              count(*) AS row_count FROM fct_orders WHERE order_ts < TIMESTAMP '1997-01-01'
       UNION ALL SELECT 1, TIMESTAMP '2024-05-14 12:00:00', 'APPEND', count(*) FROM fct_orders
       UNION ALL SELECT 2, TIMESTAMP '2024-05-16 00:00:00', 'DELETE', count(*) FROM fct_orders
       WHERE order_ts >= TIMESTAMP '2000-01-01'""",
)
def version_history(d: Domain):
    log = order_versions(d).history()
    return log.select(F.col("version").cast("int").alias("version"), "committed_at", "operation", "row_count")


@query("restore_version", "SELECT order_id, customer_id, line_total, order_ts FROM fct_orders")
def restore_version(d: Domain):
    """The full state, found by its commit time, becomes the newest version again."""
    table = order_versions(d)
    table.restore("2024-05-17 00:00:00", after="2024-05-14 00:00:00", before="2024-05-15 00:00:00", min_rows=1000)
    return table.as_of()


@query(
    "compact_files",
    """SELECT count(*) AS row_count, CAST(sum(line_total) AS DECIMAL(28,2)) AS revenue, true AS fewer_files
       FROM fct_orders""",
)
def compact_files(d: Domain):
    """The whole table as many small files, more of them where it is larger, packed into few by their sizes."""
    small, large = d.scratch("orders_small_files"), d.scratch("orders_compacted")
    d.fct_orders.repartition(max(32, layout.files_for(d.fct_orders, target_mb=4))).write.parquet(small)
    table = layout.pack_files(d.spark, small, large, sort=["order_ts", "order_id"]).read()
    files = layout.file_report(d.spark.read.parquet(small)).agg(F.count(F.lit(1)).alias("n")).scalar()
    report = layout.file_report(table).agg(F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("_files")).select(
        "row_count", (F.col("_files") < files).alias("fewer_files")
    )
    revenue = table.agg(F.sum("line_total").cast("decimal(28,2)").alias("revenue")).scalar()
    return report.withColumn("revenue", revenue)


@query("zorder_layout", "SELECT order_id, customer_id, order_ts, line_total FROM fct_orders")
def zorder_layout(d: Domain):
    """Order lines laid out by customer and time; the rows are the same."""
    source = tables.overwrite_table(
        d.fct_orders.select("order_id", "customer_id", "order_ts", "line_total"), d.scratch("orders_plain")
    )
    return tables.overwrite_table(
        layout.zorder(source, ["customer_id", "order_ts"], files=layout.files_for(source)), d.scratch("orders_zorder")
    )
