"""Row rules, key checks, quarantine split and quality reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import distinct_keys

Rules = Mapping[str, Column]


class RowCountError(ValueError):
    """A load has fewer rows than its guard demands."""


def _holds(rule: Column) -> Column:
    """A rule that evaluates to NULL counts as failed."""
    return F.coalesce(rule, F.lit(False))


def _all_hold(rules: Rules) -> Column:
    return reduce(lambda a, b: a & b, [_holds(rule) for rule in rules.values()])


def mark_known(df: DataFrame, dim: DataFrame, key: str, flag: str, dim_key: str | None = None) -> DataFrame:
    """Add boolean ``flag``: does ``key`` occur in ``dim``?  A NULL key is unknown.

    The keys stay distributed: a left join with the distinct keys.  It turns into
    a broadcast join when the key side is measured small; otherwise the adaptive
    planner splits a fact partition that holds a hot key.
    """
    keys = distinct_keys(dim.select(F.col(dim_key or key).alias(key)), key).withColumn(flag, F.lit(True))
    return df.join(keys, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def flag_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Add ``_ok`` and ``_failed_rules`` (names in rule order, empty when ok)."""
    failed = F.filter(
        F.array(*[F.when(~_holds(rule), F.lit(name)) for name, rule in rules.items()]),
        lambda name: name.isNotNull(),
    )
    return df.withColumns({"_ok": _all_hold(rules), "_failed_rules": failed})


def good_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("_ok")).drop("_ok", "_failed_rules")


def bad_rows(flagged: DataFrame, reason: str = "validation_failed") -> DataFrame:
    """The complement of :func:`good_rows`, with the reason for quarantine."""
    return (
        flagged.filter(~F.col("_ok"))
        .drop("_ok")
        .withColumn("_quarantine_reason", F.lit(reason))
    )


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Drop rows that fail any rule; works on static and streaming frames."""
    return df.filter(_all_hold(rules))


def dq_report(df: DataFrame, rules: Rules) -> DataFrame:
    """``rule, passed, failed`` per rule, from one aggregate over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_holds(rule)).alias(name) for name, rule in rules.items()],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(name).alias("passed"),
                (F.col("_rows") - F.col(name)).alias("failed"),
            )
            for name in rules
        ]
    )
    return counts.select(F.inline(entries))


def dq_score(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows, rows passing every rule, and their share (NULL for no rows)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(_all_hold(rules)).alias("passing_rows")
    ).withColumn(
        "score", F.try_divide(F.col("passing_rows").cast("double"), F.col("total_rows").cast("double"))
    )


def load_summary(flagged: DataFrame) -> DataFrame:
    """Good and quarantined counts of one load, in one pass."""
    return flagged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("_ok")).alias("good_rows"),
        F.count_if(~F.col("_ok")).alias("quarantined_rows"),
    )


def row_count_check(df: DataFrame, min_rows: int) -> DataFrame:
    """Query form of the guard: one row with the count and whether it suffices."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(min_rows).cast("long").alias("min_rows"),
        (F.col("row_count") >= min_rows).alias("passed"),
    )


def require_rows(df: DataFrame, min_rows: int) -> DataFrame:
    """Raise unless ``df`` has at least ``min_rows`` rows; stops reading at the bound."""
    found = df.limit(min_rows).count()
    if found < min_rows:
        raise RowCountError(f"expected at least {min_rows} rows, found {found}")
    return df


# --- the order and return rule sets -----------------------------------------


def flag_orders(raw: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Parse order time, check keys and price; NULL in any rule fails the row."""
    from tidemark.functions.times import parse_timestamp

    parsed = raw.withColumn("order_ts_parsed", parse_timestamp(F.col("order_ts")))
    known = mark_known(parsed, customers, "customer_id", "_known_customer")
    known = mark_known(known, products, "product_id", "_known_product")
    rules = {
        "order_id_present": F.col("order_id").isNotNull(),
        "customer_known": F.col("_known_customer"),
        "product_known": F.col("_known_product"),
        "price_positive": F.col("unit_price") > 0,
        "order_ts_valid": F.col("order_ts_parsed").isNotNull(),
    }
    return flag_rows(known, rules).drop("_known_customer", "_known_product")


def fct_orders(flagged: DataFrame) -> DataFrame:
    """The valid order lines, with ``line_total`` stored for every later query."""
    from tidemark.functions.money import line_total

    return good_rows(flagged).select(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        "unit_price",
        line_total("quantity", "unit_price").alias("line_total"),
        F.col("order_ts_parsed").alias("order_ts"),
    )


def flag_returns(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """Check return id, that the order exists, and that the refund is not negative."""
    from tidemark.functions.times import parse_date

    parsed = raw.withColumn("return_date_parsed", parse_date(F.col("return_date")))
    known = mark_known(parsed, orders, "order_id", "_known_order")
    rules = {
        "return_id_present": F.col("return_id").isNotNull(),
        "order_known": F.col("_known_order"),
        "refund_not_negative": F.col("refund_amount") >= 0,
    }
    return flag_rows(known, rules).drop("_known_order")


def fct_returns(flagged: DataFrame) -> DataFrame:
    return good_rows(flagged).select(
        "return_id",
        "order_id",
        "customer_id",
        "product_id",
        F.col("return_date_parsed").alias("return_date"),
        "reason_code",
        "refund_amount",
    )
