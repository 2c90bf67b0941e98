"""Gold tables: customer, product and revenue aggregates.

Facts are aggregated on the join key first (map-side partial sums, so hot keys
cost one row per task) and only then joined to a dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import TOTAL, average, percent, total
from tidemark.functions.times import day, moment


def _window(as_of: object, first_day: int, last_day: int = 0) -> Column:
    """``as_of - first_day <= order_ts < as_of - last_day``, in days."""
    at = moment(as_of)
    return (F.col("order_ts") >= at - F.make_interval(days=F.lit(first_day))) & (
        F.col("order_ts") < at - F.make_interval(days=F.lit(last_day))
    )


# --- customers ----------------------------------------------------------------


def order_metrics(orders: DataFrame, as_of: object) -> DataFrame:
    return (
        orders.groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            total("line_total").alias("total_spend"),
            F.count("line_total").alias("_lines"),
            F.max("order_ts").alias("last_order_ts"),
        )
        .withColumn("avg_order_value", average("total_spend", "_lines"))
        .withColumn(
            "days_since_last_order",
            F.datediff(moment(as_of).cast("date"), F.col("last_order_ts").cast("date")),
        )
        .drop("_lines")
    )


def return_metrics(returns: DataFrame) -> DataFrame:
    return returns.groupBy("customer_id").agg(
        F.count("return_id").alias("total_returns"), total("refund_amount").alias("total_refunded")
    )


def customer_metrics(
    orders: DataFrame, returns: DataFrame, customers: DataFrame, as_of: object
) -> DataFrame:
    """Lifetime metrics of every customer; no orders means 0, with an unknown last order."""
    return (
        customers.join(order_metrics(orders, as_of), "customer_id", "left")
        .join(return_metrics(returns), "customer_id", "left")
        .fillna(
            0,
            subset=["total_orders", "total_spend", "avg_order_value", "total_returns", "total_refunded"],
        )
    )


def customer_rfm_90d(
    orders: DataFrame, customers: DataFrame, as_of: object, days: int = 90
) -> DataFrame:
    """Recency over all time; frequency, spend and a yearly value estimate over ``days``."""
    at = moment(as_of)
    recent = F.col("order_ts") >= at - F.make_interval(days=F.lit(days))
    per_customer = orders.groupBy("customer_id").agg(
        F.max("order_ts").alias("last_order_at"),
        F.count_if(recent).alias("order_count_90d"),
        F.sum(F.when(recent, F.col("line_total"))).cast(TOTAL).alias("total_spend_90d"),
    )
    joined = customers.join(per_customer, "customer_id", "left").fillna(
        0, subset=["order_count_90d", "total_spend_90d"]
    )
    return joined.withColumns(
        {
            "days_since_last_order": F.datediff(at.cast("date"), F.col("last_order_at").cast("date")),
            "avg_order_value_90d": F.coalesce(
                average("total_spend_90d", "order_count_90d"), F.lit(0).cast(TOTAL)
            ),
        }
    ).withColumn(
        "clv_estimate",
        (F.col("avg_order_value_90d") * F.col("order_count_90d") * 4).cast(TOTAL),
    )


def segment_churn_risk(metrics: DataFrame, days: int = 90) -> DataFrame:
    """Customers and share at risk per segment: silent for over ``days``, or no order ever."""
    recency = F.col("days_since_last_order")
    at_risk = recency.isNull() | (recency > days)
    return (
        metrics.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"), F.count_if(at_risk).alias("at_risk"))
        .withColumn("at_risk_pct", percent("at_risk", "customers"))
    )


# --- products -----------------------------------------------------------------


def product_performance(orders: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """Sales and return rate of every product.

    ``total_units_sold`` counts order lines.
    """
    sold = orders.groupBy("product_id").agg(
        F.count("order_id").alias("total_units_sold"),
        total("line_total").alias("total_revenue"),
        F.avg("quantity").alias("avg_quantity_per_order"),
    )
    returned = returns.groupBy("product_id").agg(F.count("return_id").alias("total_returns"))
    return (
        products.join(sold, "product_id", "left")
        .join(returned, "product_id", "left")
        .fillna(0)
        .withColumn("return_rate_pct", percent("total_returns", "total_units_sold"))
    )


def product_trend_7d(orders: DataFrame, products: DataFrame, as_of: object) -> DataFrame:
    """Sales of the last 7 days against the 7 days before; score 0 without prior sales.

    The bound of 14 days is a filter below the aggregate; facts partitioned by date skip the rest.
    """
    this_week = _window(as_of, 7)
    last_week = _window(as_of, 14, 7)
    sales = (
        orders.filter(_window(as_of, 14))
        .groupBy("product_id")
        .agg(
            F.sum(F.when(this_week, F.col("line_total"))).cast(TOTAL).alias("gmv_7d"),
            F.sum(F.when(this_week, F.col("quantity"))).cast("long").alias("units_7d"),
            F.sum(F.when(last_week, F.col("line_total"))).cast(TOTAL).alias("gmv_prior_7d"),
        )
    )
    return (
        products.join(sales, "product_id", "left")
        .fillna(0, subset=["gmv_7d", "units_7d", "gmv_prior_7d"])
        .withColumn("trend_score", percent(F.col("gmv_7d") - F.col("gmv_prior_7d"), "gmv_prior_7d", 2))
    )


def trending_products(trend: DataFrame, limit: int) -> DataFrame:
    """The strongest risers and decliners, each side ranked by its own top-k."""
    columns = ["direction", "product_id", "trend_score", "gmv_7d", "gmv_prior_7d"]
    rising = trend.filter("trend_score > 0").withColumn("direction", F.lit("rising"))
    falling = trend.filter("trend_score < 0").withColumn("direction", F.lit("declining"))
    return (
        rising.orderBy(F.desc("trend_score"), "product_id").limit(limit).select(*columns)
        .unionByName(falling.orderBy("trend_score", "product_id").limit(limit).select(*columns))
    )


# --- revenue ------------------------------------------------------------------


def daily_orders(orders: DataFrame) -> DataFrame:
    return (
        orders.withColumn("order_date", day(F.col("order_ts")))
        .groupBy("order_date")
        .agg(F.count("order_id").alias("num_orders"), total("line_total").alias("gross_revenue"))
    )


def daily_refunds(returns: DataFrame) -> DataFrame:
    return (
        returns.groupBy("return_date")
        .agg(total("refund_amount").alias("total_refunds"))
        .withColumnRenamed("return_date", "order_date")
    )


def revenue_daily(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Gross, refunds and net per order day; days with refunds only do not appear."""
    return (
        daily_orders(orders)
        .join(daily_refunds(returns), "order_date", "left")
        .fillna(0, subset=["total_refunds"])
        .withColumn("net_revenue", (F.col("gross_revenue") - F.col("total_refunds")).cast(TOTAL))
        .orderBy("order_date")
    )


def revenue_by(orders: DataFrame, *dimensions: str) -> DataFrame:
    """Total, count and average order value per group, e.g. date x category x region."""
    return (
        orders.withColumn("order_date", day(F.col("order_ts")))
        .groupBy(*dimensions)
        .agg(total("line_total").alias("total_revenue"), F.count("order_id").alias("order_count"))
        .withColumn("avg_order_value", average("total_revenue", "order_count"))
    )


def revenue_last_days(orders: DataFrame, as_of: object, *dimensions: str, days: int = 7) -> DataFrame:
    """Revenue per group over the ``days`` before ``as_of``."""
    return (
        orders.filter(_window(as_of, days))
        .groupBy(*dimensions)
        .agg(total("line_total").alias("total_revenue"), F.count(F.lit(1)).alias("order_count"))
    )


def windowed_revenue(orders: DataFrame, ts: str, dimension: str, amount: str) -> DataFrame:
    """Sum per tumbling day and dimension; the streaming form adds a watermark first."""
    return (
        orders.groupBy(F.window(ts, "1 day"), dimension)
        .agg(total(amount).alias("daily_revenue"))
        .select(F.col("window.start").alias("window_start"), dimension, "daily_revenue")
    )


def revenue_enriched(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Daily revenue by current customer segment and product brand.

    Facts meet both narrow dimensions first: (day, customer, product) hardly repeats, so
    grouping by it would shuffle all facts without making them fewer.
    """
    dated = orders.select(
        day(F.col("order_ts")).alias("order_date"), "customer_id", "product_id", "order_id", "line_total"
    )
    return (
        dated.join(customers.select("customer_id", "segment"), "customer_id")
        .join(products.select("product_id", "brand"), "product_id")
        .groupBy("order_date", "segment", "brand")
        .agg(total("line_total").alias("total_revenue"), F.count("order_id").alias("order_count"))
    )


def revenue_by_category(orders: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Revenue per category through its surrogate id, grouped by id and name."""
    per_product = orders.groupBy("product_id").agg(total("line_total").alias("_revenue"))
    return (
        per_product.join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(total("_revenue").alias("revenue"))
        .join(categories.select("category_id", "category_name"), "category_id")
        .groupBy("category_id", "category_name")
        .agg(total("revenue").alias("revenue"))
    )


def reconcile(reported: DataFrame, raw: DataFrame, key: str, amount: str) -> DataFrame:
    """Both totals and their difference per key, including keys on one side only."""
    left = reported.groupBy(key).agg(total(amount).alias("reported"))
    right = raw.groupBy(key).agg(total(amount).alias("raw"))
    zero = F.lit(0).cast(TOTAL)
    return (
        left.join(right, key, "full")
        .withColumns(
            {"reported": F.coalesce("reported", zero), "raw": F.coalesce("raw", zero)}
        )
        .withColumn("difference", (F.col("reported") - F.col("raw")).cast(TOTAL))
        .withColumn("matches", F.col("difference") == 0)
    )


def top(df: DataFrame, by: str, limit: int, *ties: str) -> DataFrame:
    """Greatest ``limit`` rows; each task keeps only that many (no full sort)."""
    return df.orderBy(F.desc(by), *ties).limit(limit)


def table_stats(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(ts).alias("latest"))
