"""Newest row per key, duplicates, and key reports.

Newest-per-key is an aggregate (the greatest ordering struct), not a window:
rows of a hot key are reduced on the map side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Each complete key once, as the key side of a join.  Repeats vanish before the shuffle."""
    return splittable_groups(df.select(*keys).dropna(), *keys).agg(F.lit(True)).select(*keys)


def splittable_groups(df: DataFrame, *keys: str) -> GroupedData:
    """Group for a result that will be joined with many rows per key.

    An aggregate over the join key alone would also serve as that side's
    shuffle, and the adaptive planner splits a hot partition only where both
    sides of the join have a shuffle of their own.  Grouping by a hash of the key
    as well gives the same groups under another partitioning, so the join adds
    its own (the aggregated side is narrow) and stays splittable.
    """
    return df.groupBy(*keys, F.xxhash64(*keys).alias("_group_hash"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: greatest ``order`` columns, then greatest remaining columns.

    The tie-break over every column makes the choice independent of row order.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and not order:
        return df.distinct()
    ranked = F.struct(*[F.col(c) for c in [*order, *rest]])
    best = df.groupBy(*keys).agg(F.max(ranked).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest over the remaining columns."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns])


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def append_new(target: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """The rows to append: one per key, only keys the target does not hold yet.

    Rows without a key cannot be deduplicated and are left out.
    """
    complete = source.dropna(subset=list(keys))
    return first_per_key(complete, keys).join(distinct_keys(target, *keys), list(keys), "left_anti")


def append_dedup(target: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """The target after the append."""
    return target.unionByName(append_new(target, source, *keys))


def fk_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent and how many rows carry them.

    Children are counted per key before the join, so a hot orphan key is one row.
    """
    counted = child.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    parents = distinct_keys(parent.select(F.col(parent_key or key).alias(key)), key)
    return counted.join(parents, key, "left_anti")


def join_fanout(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows before and after joining ``dim``, from per-key counts alone.

    Multiplying counts gives the joined row count without producing the join,
    so a duplicated hot key cannot blow up the check itself.
    """
    facts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_facts"))
    dims = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_dims"))
    per_key = facts.join(dims, key, "left")
    matches = F.coalesce(F.col("_dims"), F.lit(0))
    wide = "decimal(38,0)"
    return per_key.agg(
        F.sum("_facts").alias("fact_rows"),
        F.coalesce(F.sum((F.col("_facts") * F.greatest(matches, F.lit(1))).cast("decimal(28,0)")), F.lit(0))
        .cast(wide)
        .alias("joined_rows"),
        F.count_if(matches > 1).alias("duplicated_keys"),
    ).withColumn("fans_out", F.col("joined_rows") > F.col("fact_rows"))
