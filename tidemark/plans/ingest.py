"""Queries over sources and sinks.  Files are written below the shared scratch
folder and read back, so each query is a full round trip of its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.money import PRICE, total
from tidemark.operators import history, merge
from tidemark.operators.gold import revenue_daily, table_stats
from tidemark.plans.domain import PRODUCT_COLUMNS, V1_DATE, V2_DATE, Domain
from tidemark.plans.registry import query
from tidemark.sinks import tables
from tidemark.sinks.increments import ResumableLoad
from tidemark.sources import files, literals, schemas
from tidemark.streaming.sinks import run_to_table


def write_csv(df, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def returns_feed(d: Domain):
    """Returns in the column order and types of the incoming CSV files."""
    names = [c.split()[0] for c in schemas.RETURNS.split(", ")]
    return d.returns_raw.select(*names)


@query(
    "csv_scan",
    "SELECT *, '1995-01-01' AS signup_date, TRUE AS has_ingest_time FROM customers",
)
def csv_scan(d: Domain):
    """Customers written as CSV and read back under the declared layout."""
    path = d.scratch("customers_csv")
    names = [c.split()[0] for c in schemas.CUSTOMERS.split(", ")]
    write_csv(d.customers.withColumn("signup_date", F.lit("1995-01-01")).select(*names), path)
    rows = files.csv_scan(d.spark, path, schemas.CUSTOMERS)
    return rows.withColumn("has_ingest_time", F.col("_ingested_at").isNotNull()).drop("_ingested_at")


@query(
    "csv_scan_lineage",
    """SELECT return_id, order_id, customer_id, product_id, return_date, reason_code,
              refund_amount, TRUE AS has_source_file FROM returns_raw""",
)
def csv_scan_lineage(d: Domain):
    path = d.scratch("returns_csv")
    write_csv(returns_feed(d), path)
    rows = files.csv_scan_lineage(d.spark, path, schemas.RETURNS)
    return rows.select(
        *returns_feed(d).columns[:-1],
        F.col("refund_amount").cast(PRICE).alias("refund_amount"),
        F.col("_source_file").endswith(".csv").alias("has_source_file"),
    )


@query(
    "incremental_files",
    """SELECT return_id, order_id, return_date, refund_amount,
              CASE WHEN return_date < '1998-01-01' THEN 1 ELSE 2 END AS load_run
       FROM returns_raw""",
)
def incremental_files(d: Domain):
    """Two runs of one checkpointed stream; the second run sees only the new files."""
    source, table, checkpoint = (d.scratch(f"returns_{n}") for n in ("drops", "loaded", "state"))
    drops = [F.col("return_date") < "1998-01-01", F.col("return_date") >= "1998-01-01"]
    for run, due in enumerate(drops, start=1):
        write_csv(returns_feed(d).filter(due), source, "append")
        stream = files.csv_increments(d.spark, source, schemas.RETURNS)
        loaded = run_to_table(stream.withColumn("load_run", F.lit(run)), table, checkpoint)
    return loaded.select(
        "return_id", "order_id", "return_date", F.col("refund_amount").cast(PRICE).alias("refund_amount"), "load_run"
    )


@query(
    "schema_evolution",
    """SELECT order_id, customer_id, line_total,
              CASE WHEN order_ts < TIMESTAMP '1998-01-01' THEN NULL
                   ELSE CAST(unit_price AS DECIMAL(14,2)) END AS lifetime_value
       FROM fct_orders""",
)
def schema_evolution(d: Domain):
    """A column that appears in newer files: typed by a hint, NULL for the older ones."""
    old = d.fct_orders.filter("order_ts < timestamp_ntz'1998-01-01'")
    new = d.fct_orders.filter("order_ts >= timestamp_ntz'1998-01-01'")
    paths = d.scratch("orders_layout_1"), d.scratch("orders_layout_2")
    columns = ["order_id", "customer_id", "line_total"]
    tables.overwrite_table(old.select(*columns), paths[0])
    tables.overwrite_table(
        new.select(*columns, F.col("unit_price").cast("string").alias("lifetime_value")), paths[1]
    )
    return files.evolve(
        d.spark.read.parquet(paths[0]),
        d.spark.read.parquet(paths[1]),
        hints={"lifetime_value": "decimal(14,2)"},
    )


_CATALOGUE = ", ".join(
    f"('{i}', '{n}', '{c}', {p}, '{s}')" for i, n, c, p, s in literals.PRODUCTS
)


@query(
    "inline_products",
    f"""SELECT v.product_id, v.product_name, v.category, CAST(v.unit_price AS DOUBLE) AS unit_price,
               v.supplier_id, coalesce(n, 0) AS order_lines,
               CAST(coalesce(s, 0) AS DECIMAL(28,2)) AS revenue
        FROM (VALUES {_CATALOGUE}) v(product_id, product_name, category, unit_price, supplier_id)
        LEFT JOIN (SELECT product_id, count(*) AS n, sum(line_total) AS s
                   FROM fct_orders GROUP BY 1) o ON o.product_id = v.product_id""",
)
def inline_products(d: Domain):
    """The literal catalogue with the sales of each entry."""
    sales = d.fct_orders.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("order_lines"), total("line_total").alias("revenue")
    )
    return (
        literals.inline_products(d.spark)
        .join(sales, "product_id", "left")
        .fillna(0, subset=["order_lines", "revenue"])
    )


@query(
    "load_regions",
    """SELECT r.*, coalesce(n, 0) AS customers FROM regions r
       LEFT JOIN (SELECT region, count(*) AS n FROM customers GROUP BY 1) ON region = region_code""",
)
def load_regions(d: Domain):
    path = d.scratch("regions_csv")
    tables.export_csv(d.regions, path)
    per_region = d.customers.groupBy("region").agg(F.count(F.lit(1)).alias("customers"))
    return (
        per_region.withColumnRenamed("region", "region_code")
        .join(files.load_regions(d.spark, path), "region_code", "right")
        .fillna(0, subset=["customers"])
    )


def category_rows(d: Domain):
    """One reference row per (type, brand) pair in the parts table."""
    return (
        d.products.select("category", F.col("brand").alias("sub_category"))
        .distinct()
        .select(
            "category",
            "sub_category",
            F.concat_ws(" / ", "category", "sub_category").alias("display_name"),
            F.when(F.col("category") == "promo", "true").otherwise("false").alias("is_seasonal"),
            F.when(F.length("sub_category") > 7, "high").otherwise("low").alias("margin_band"),
        )
    )


CATEGORY_SQL = """
    SELECT DISTINCT category, brand AS sub_category, category || ' / ' || brand AS display_name,
           category = 'promo' AS is_seasonal,
           CASE WHEN length(brand) > 7 THEN 'high' ELSE 'low' END AS margin_band
    FROM products"""


@query(
    "load_categories",
    f"""SELECT c.*, n AS products FROM ({CATEGORY_SQL}) c
        JOIN (SELECT category, brand, count(*) AS n FROM products GROUP BY 1, 2) p
        ON p.category = c.category AND p.brand = c.sub_category""",
)
def load_categories(d: Domain):
    path = d.scratch("categories_csv")
    tables.export_csv(category_rows(d), path)
    per_pair = d.products.groupBy("category", F.col("brand").alias("sub_category")).agg(
        F.count(F.lit(1)).alias("products")
    )
    return per_pair.join(files.load_categories(d.spark, path), ["category", "sub_category"])


def change_log(d: Domain, op_delete: bool = True):
    """Both customer loads as a change log; deletes for the keys that left."""
    v1 = d.customers_v1.withColumns({"op": F.lit("upsert"), "seq": F.lit(V1_DATE).cast("timestamp_ntz")})
    v2 = d.customers_v2.withColumns({"op": F.lit("upsert"), "seq": F.lit(V2_DATE).cast("timestamp_ntz")})
    gone = (
        d.customers_v1.join(d.customers_v2.select("customer_id"), "customer_id", "left_anti")
        .withColumns({"op": F.lit("delete"), "seq": F.lit(V2_DATE).cast("timestamp_ntz")})
    )
    log = v1.unionByName(v2)
    return log.unionByName(gone) if op_delete else log


@query("cdc_apply", "SELECT * FROM customers_v2")
def cdc_apply(d: Domain):
    """Full first load, then only changed rows: inserts, updates and deletes."""
    first = merge.cdc_apply(None, d.customers_v1.withColumns({"op": F.lit("upsert"), "seq": F.lit(1)}), "customer_id", "seq")
    later = change_log(d).filter(F.col("seq") == F.lit(V2_DATE).cast("timestamp_ntz"))
    return merge.cdc_apply(first, later, "customer_id", "seq")


@query("cdc_resume", "SELECT * FROM customers_v2")
def cdc_resume(d: Domain):
    """The change log loaded in three steps: all of it up to the first mark, then what is above, then nothing new."""
    log = d.stored(change_log(d), "customer_log")
    load = ResumableLoad(d.spark, d.scratch("customer_load"), "customer_id", "seq", late=F.expr("INTERVAL 1 DAY"))
    load.load(log.filter(F.col("seq") == F.lit(V1_DATE).cast("timestamp_ntz")))
    load.load(log)
    load.load(log)
    return load.read()


@query(
    "price_history",
    """WITH feed AS (
         SELECT product_id, unit_price, TIMESTAMP '1995-01-01' AS ts FROM products_v1 UNION ALL
         SELECT product_id, unit_price, TIMESTAMP '1998-01-01' FROM products_v2)
       SELECT product_id, unit_price, ts AS valid_from,
              coalesce(lead(ts) OVER (PARTITION BY product_id ORDER BY ts),
                       TIMESTAMP '9999-12-31') AS valid_to FROM feed""",
)
def price_history(d: Domain):
    feed = d.products_v1.withColumn("ts", F.lit(V1_DATE).cast("timestamp_ntz")).unionByName(
        d.products_v2.withColumn("ts", F.lit(V2_DATE).cast("timestamp_ntz"))
    )
    return history.price_history(feed, "product_id", "ts", ["unit_price"])


@query("overwrite_table", "SELECT * FROM daily_revenue")
def overwrite_table(d: Domain):
    """Replaced catalog table: first another layout, then the final rows and schema."""
    path = d.scratch("revenue_table")
    name = f"gold_{path[-32:]}.revenue_daily"
    tables.save_table(d.regions, name, path=path)
    tables.save_table(revenue_daily(d.fct_orders, d.fct_returns), name, path=path)
    # The entry was for this run only; the files at the path stay.
    d.spark.sql(f"DROP SCHEMA {name.split('.')[0]} CASCADE")
    return d.spark.read.parquet(path)


@query("append_table", "SELECT order_id, customer_id, line_total, order_ts FROM fct_orders")
def append_table(d: Domain):
    """Order lines appended in two loads, before and from 1998."""
    path = d.scratch("orders_appended")
    rows = d.fct_orders.select("order_id", "customer_id", "line_total", "order_ts")
    tables.append_table(rows.filter("order_ts < timestamp_ntz'1998-01-01'"), path)
    return tables.append_table(rows.filter("order_ts >= timestamp_ntz'1998-01-01'"), path)


@query(
    "create_or_merge",
    """SELECT product_id, product_name, category, unit_price, supplier_id,
              TIMESTAMP '1998-01-01' AS _last_updated FROM products_v2
       UNION ALL
       SELECT product_id, product_name, category, unit_price, supplier_id,
              TIMESTAMP '1995-01-01' FROM products_v1
       WHERE product_id NOT IN (SELECT product_id FROM products_v2)""",
)
def create_or_merge(d: Domain):
    """First run creates the product dimension, the second merges into its buckets."""
    path = d.scratch("products")
    for source, at in ((d.products_v1, V1_DATE), (d.products_v2, V2_DATE)):
        table = tables.create_or_merge(
            source,
            path,
            "product_id",
            lambda target, rows, at=at: merge.scd1_upsert(target, rows, "product_id", PRODUCT_COLUMNS, at),
            buckets=8,
        )
    return table


@query(
    "csv_export",
    """SELECT customer_id, count(order_id) AS total_orders,
              CAST(sum(line_total) AS DECIMAL(28,2)) AS total_spend
       FROM fct_orders GROUP BY 1""",
)
def csv_export(d: Domain):
    """Customer totals exported as CSV (kept parallel) and read back."""
    path = d.scratch("export")
    totals = d.fct_orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), total("line_total").alias("total_spend")
    )
    tables.export_csv(totals, path, files=None)
    schema = "customer_id STRING, total_orders BIGINT, total_spend DECIMAL(28,2)"
    return files.csv_scan(d.spark, path, schema).drop("_ingested_at")


@query(
    "partitioned_write",
    """SELECT CAST(order_ts AS DATE) AS partition_date, count(*) AS order_lines,
              CAST(sum(line_total) AS DECIMAL(28,2)) AS revenue
       FROM fct_orders WHERE order_ts >= TIMESTAMP '1998-01-01' GROUP BY 1""",
)
def partitioned_write(d: Domain):
    """Order lines partitioned by month folder date, then read with a date filter."""
    table = tables.write_partitioned(d.fct_orders, d.scratch("orders_by_date"), "order_ts")
    return (
        table.filter(F.col("_partition_date") >= F.lit("1998-01-01").cast("date"))
        .groupBy(F.col("_partition_date").alias("partition_date"))
        .agg(F.count(F.lit(1)).alias("order_lines"), total("line_total").alias("revenue"))
    )


@query(
    "table_stats",
    "SELECT count(*) AS row_count, max(o_orderdate) AS latest FROM orders",
)
def stats(d: Domain):
    return table_stats(d.table("orders"), "o_orderdate")


