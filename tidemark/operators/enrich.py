"""Joins with reference tables.

A side is broadcast only after its size was measured; a larger one takes the
ordinary join, which the adaptive planner may still broadcast or split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import distinct_keys

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def is_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure at most ``max_rows + 1`` rows: row count and the bytes of their text form."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("long") for c in df.columns),
        F.lit(16),
    )
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def enriched_revenue(revenue: DataFrame, regions: DataFrame) -> DataFrame:
    """Revenue rows with the attributes of their region; unknown regions keep NULLs."""
    small = broadcast_if_small(regions)
    return revenue.join(small, revenue["region"] == small["region_code"], "left").drop("region_code")


def with_two_dimensions(
    fact: DataFrame,
    regions: DataFrame,
    customers: DataFrame,
    columns: Sequence[str],
) -> DataFrame:
    """Fact rows with region and current-customer attributes, projected to ``columns``."""
    return (
        fact.join(broadcast_if_small(regions), "region_code", "left")
        .join(broadcast_if_small(customers), "customer_id", "left")
        .select(*columns)
    )


def with_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Left join on the composite key (category, sub_category)."""
    return products.join(broadcast_if_small(categories), ["category", "sub_category"], "left")


def new_rows(source: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Source rows whose key has no current row."""
    return source.join(distinct_keys(current, key), key, "left_anti")


def known_facts(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Facts whose customer and product both exist."""
    for dim, key in ((customers, "customer_id"), (products, "product_id")):
        fact = fact.join(distinct_keys(dim, key), key, "left_semi")
    return fact
