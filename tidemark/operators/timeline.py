"""Ordered operators along a key's timeline that survive hot keys.

A plain window over ``partitionBy(key)`` puts all rows of one key into one task.
So rows are counted per key first (reduced on the map side).  Where no key is
hot, the plain window follows.  Otherwise the timeline of each *hot* key is cut
into fixed time chunks, each a window group of its own, and one boundary row per
(key, chunk) carries what a chunk has to know from its neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.enrich import broadcast_if_small
from tidemark.session import stored

DAY = 86_400
HOT_ROWS = 1_000_000


def chunk_of(ts: str | Column, seconds: int | Column = DAY) -> Column:
    """Number of the time chunk that holds a date or timestamp."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_timestamp(column.cast("timestamp")) / (F.lit(seconds) if isinstance(seconds, int) else seconds)).cast("long")


def hot_groups(counts: DataFrame, group: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """Groups of a ``group..., _rows`` frame with more than ``hot_rows`` rows, or None.

    ``_shares`` says into how many parts of that size a group would fall.  The groups
    stay a (stored) table, however many there are; it is broadcast only when
    measured small.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    shares = F.ceil(F.col("_rows") / F.lit(max(limit, 1))).cast("int")
    found = stored(counts.filter(F.col("_rows") > limit).select(*group, shares.alias("_shares")), "hot-groups")
    return None if found.isEmpty() else broadcast_if_small(found)


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    out: str,
    *,
    following: bool,
    seconds: int = DAY,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add struct ``out``: ``values`` of the next (or previous) row of the same key.

    ``order`` starts with the time column and must identify a row within its key.
    ``out`` is NULL at the end of the timeline, never for a NULL neighbour value.
    """
    shift = F.lead if following else F.lag
    hot = hot_groups(_count(df, keys), keys, hot_rows)
    if hot is None:
        return df.withColumn(out, shift(F.struct(*values)).over(W.partitionBy(*keys).orderBy(*order)))

    pick, step = (F.min, F.lag) if following else (F.max, F.lead)
    rows = _with_chunk(df, keys, order[0], hot, seconds).withColumn(
        "_point", F.struct(*[F.col(c) for c in order], F.struct(*values).alias("_value"))
    )
    edges = rows.filter(F.col("_chunk").isNotNull()).groupBy(*keys, "_chunk").agg(pick("_point").alias("_point"))
    # The edge row of a chunk is lent to the neighbouring chunk of that key.
    lent = edges.withColumn(
        "_chunk", step("_chunk").over(W.partitionBy(*keys).orderBy("_chunk"))
    ).filter(F.col("_chunk").isNotNull())
    both = rows.withColumn("_lent", F.lit(False)).unionByName(
        lent.withColumn("_lent", F.lit(True)), allowMissingColumns=True
    )
    window = W.partitionBy(*keys, "_chunk").orderBy(*[F.col(f"_point.{c}") for c in order])
    return (
        both.withColumn(out, shift("_point").over(window)["_value"])
        .filter(~F.col("_lent"))
        .select(*df.columns, out)
    )


def last_version(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    start: str,
    values: Sequence[str],
    out: str = "_version",
    seen: str | None = None,
    seconds: int = DAY,
    hot_rows: int | None = None,
) -> DataFrame:
    """For each fact the latest version of its key with ``start <= ts``.

    Adds struct ``out`` (NULL when no version had started) and, on request,
    ``seen``: how many versions had started by then.  Of versions that start
    together the one with the greatest ``values`` counts as the latest.  Work is
    linear in facts + versions; pairs are never formed.
    """
    members = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
    counted = _count(facts, [key]).unionByName(_count(members, [key]))
    hot = hot_groups(counted.groupBy(key).agg(F.sum("_rows").alias("_rows")), [key], hot_rows)
    points = members.select(
        key,
        start,
        F.col(start).cast("timestamp_ntz").alias("_at"),
        F.struct(*values).alias("_payload"),
        F.lit(1).cast("long").alias("_n"),
        F.lit(1).alias("_kind"),
    )
    fact_rows = facts.withColumns({"_at": F.col(ts).cast("timestamp_ntz"), "_kind": F.lit(2)})
    if hot is None:
        group, known = [key], points.drop(start)
    else:
        group = [key, "_chunk", "_share"]
        fact_rows, known = _cut(
            _with_chunk(fact_rows, [key], ts, hot, seconds),
            _with_chunk(points, [key], start, hot, seconds).drop(start),
            facts.columns,
            key,
            hot_rows,
        )
    # Order inside a group: carried version, then versions before facts of equal time.
    so_far = (
        W.partitionBy(*group)
        .orderBy(F.col("_kind") > 0, "_at", "_kind", "_payload")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    result = fact_rows.unionByName(known, allowMissingColumns=True).withColumn(
        out, F.last("_payload", ignorenulls=True).over(so_far)
    )
    if seen is not None:
        result = result.withColumn(seen, F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
    added = [c for c in (out, seen) if c is not None]
    return result.filter(F.col("_kind") == 2).select(*facts.columns, *added)


def _cut(
    fact_rows: DataFrame, points: DataFrame, columns: Sequence[str], key: str, hot_rows: int | None
) -> tuple[DataFrame, DataFrame]:
    """Facts and versions with ``_share``, the versions with those carried into each chunk.

    Facts do not depend on each other, so a chunk that is still too large is
    dealt out over several groups, each with its own copy of the chunk's versions.
    """
    group = [key, "_chunk"]
    chunks = _count(fact_rows.filter(F.col("_chunk").isNotNull()), group)
    carried = _carried_versions(points.filter(F.col("_chunk").isNotNull()), chunks, key)
    known = points.unionByName(carried.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    shares = hot_groups(chunks, group, hot_rows)
    if shares is None:
        return fact_rows.withColumn("_share", F.lit(0)), known.withColumn("_share", F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1))
    share = F.pmod(F.xxhash64(*columns), F.col("_shares")).cast("int")
    return (
        fact_rows.join(shares, group, "left")
        .withColumn("_share", F.coalesce(share, F.lit(0)))
        .drop("_shares"),
        known.join(shares, group, "left").withColumn("_share", copies).drop("_shares"),
    )


def _count(df: DataFrame, group: Sequence[str]) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))


def _with_chunk(
    df: DataFrame, keys: Sequence[str], ts: str, hot: DataFrame, seconds: int
) -> DataFrame:
    """Add ``_chunk``: the time chunk for rows of a hot key, NULL for all others.

    Chunks get narrower as a key gets hotter (down to a second), so a key whose
    changes all fall on one day is cut as well.
    """
    width = F.greatest(F.floor(F.lit(seconds) / F.col("_shares")), F.lit(1))
    marks = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], width.alias("_width"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return (
        df.join(marks, same, "left")
        .withColumn("_chunk", F.when(F.col("_width").isNotNull(), chunk_of(ts, F.col("_width"))))
        .select(*df.columns, "_chunk")
    )


def _carried_versions(points: DataFrame, fact_chunks: DataFrame, key: str) -> DataFrame:
    """Per (key, chunk) with facts: the latest version from earlier chunks and how many
    versions those hold.  Works on one row per chunk."""
    chunk_ends = points.groupBy(key, "_chunk").agg(
        F.max(F.struct("_at", "_payload"))["_payload"].alias("_payload"),
        F.count(F.lit(1)).alias("_n"),
    )
    earlier = W.partitionBy(key).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    return (
        chunk_ends.unionByName(fact_chunks, allowMissingColumns=True)
        .groupBy(key, "_chunk")
        .agg(
            F.max(F.struct(F.col("_n").isNotNull().alias("has"), "_payload", "_n")).alias("_own"),
            F.bool_or(F.col("_rows").isNotNull()).alias("_needed"),
        )
        .select(
            key,
            "_chunk",
            "_needed",
            F.last(F.col("_own._payload"), ignorenulls=True).over(earlier).alias("_payload"),
            F.coalesce(F.sum(F.col("_own._n")).over(earlier), F.lit(0)).alias("_n"),
        )
        .filter(F.col("_needed") & F.col("_payload").isNotNull())
        .drop("_needed")
    )
