"""Upserts and guarded replacement, as full new states of the target.

Plain file tables have no MERGE.  Each function returns the state after the
merge; a sink writes it as the next version and readers switch to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import moment
from tidemark.operators.keys import latest_per_key
from tidemark.operators.validation import require_rows


def scd1_upsert(
    target: DataFrame | None,
    source: DataFrame,
    key: str,
    columns: Sequence[str],
    as_of: object,
    order: Sequence[str] = (),
) -> DataFrame:
    """Source rows replace the target rows of the same key; other rows stay.

    ``order`` names the columns that decide between several source rows of one
    key.  Every source row is stamped ``_last_updated``, even without a change.
    """
    newest = latest_per_key(source.dropna(subset=[key]), [key], order)
    incoming = newest.select(key, *columns).withColumn("_last_updated", moment(as_of))
    if target is None:
        return incoming
    kept = target.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming)


def conditional_update(
    target: DataFrame,
    source: DataFrame,
    key: str,
    condition: Column,
    changes: dict[str, Column],
) -> DataFrame:
    """Update matched target rows where ``condition`` holds.

    Both sides are visible to the expressions as ``t.`` and ``s.``.  Of source rows
    that share a key the greatest counts, so target rows never multiply.
    """
    once = latest_per_key(source.dropna(subset=[key]), [key], [])
    joined = target.alias("t").join(
        once.withColumn("_matched", F.lit(True)).alias("s"),
        F.col(f"t.{key}") == F.col(f"s.{key}"),
        "left",
    )
    hit = F.col("s._matched").isNotNull() & F.coalesce(condition, F.lit(False))
    return joined.select(
        *[
            F.when(hit, changes[c]).otherwise(F.col(f"t.{c}")).alias(c) if c in changes else F.col(f"t.{c}")
            for c in target.columns
        ]
    )


def truncate_load(source: DataFrame, min_rows: int = 1) -> DataFrame:
    """The new content of a fully replaced table; raises when it looks too small."""
    return require_rows(source, min_rows)


def staged_upsert(
    target: DataFrame | None,
    staged: DataFrame,
    key: str,
    columns: Sequence[str],
    min_rows: int,
    as_of: object,
    order: Sequence[str] = (),
) -> DataFrame:
    """Drop rows without a key, check the count, then upsert.

    The check runs before anything is returned, so a failed load leaves the
    target as it was.
    """
    checked = require_rows(staged.filter(F.col(key).isNotNull()), min_rows)
    return scd1_upsert(target, checked, key, columns, as_of, order)


def cdc_apply(
    target: DataFrame | None,
    log: DataFrame,
    key: str,
    seq: str,
    op: str = "op",
    delete: str = "delete",
) -> DataFrame:
    """Apply a change log: the newest change per key wins, a delete removes the key.

    Without a target the log is a full first load.  Changes without a key are left out.
    """
    newest = latest_per_key(log.dropna(subset=[key]), [key], [seq])
    alive = newest.filter(~F.col(op).eqNullSafe(F.lit(delete))).drop(op, seq)
    if target is None:
        return alive
    return target.join(newest.select(key), key, "left_anti").unionByName(alive)
