"""Point-in-time joins of facts with versioned dimensions.

A version of a key ends where the next one starts (see ``scd2_integrity``), so
the version valid at a time is the latest one started by then, if it has not
ended.  That is found by one ordered pass, not by pairing a key's facts with all
of its versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import open_end
from tidemark.operators.enrich import is_small
from tidemark.operators.keys import splittable_groups
from tidemark.operators.timeline import DAY, last_version
from tidemark.session import stored


def point_in_time(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    values: Sequence[str],
    start: str = "valid_from",
    end: str = "valid_to",
    closed: bool = False,
    seconds: int = DAY,
) -> DataFrame:
    """Inner join on ``start <= ts < end`` (``<= end`` when ``closed``); open end = NULL.

    The closed form matches the closing instant with both neighbours, so a fact
    on a boundary appears once for each.  Versions of a key must not overlap; where they
    may, use ``point_in_time_overlapping``.
    """
    usable = fact.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    versions = dim.withColumn(end, F.coalesce(F.col(end).cast("timestamp_ntz"), open_end()))
    found = last_version(usable, versions, key, ts, start, [end, *values], seconds=seconds)
    moment = F.col(ts).cast("timestamp_ntz")
    inside = (
        found.filter(moment < F.col(f"_version.{end}"))
        .select(*fact.columns, *[F.col(f"_version.{c}").alias(c) for c in values])
    )
    if not closed:
        return inside
    closing = versions.select(
        F.col(key), F.col(end).alias("_instant"), *[F.col(c) for c in values]
    ).filter(F.col("_instant").isNotNull())
    candidates = usable.withColumn("_instant", moment)
    instants = closing.select("_instant").distinct()
    if is_small(instants):  # as with loads in batches: the other facts need no second shuffle
        candidates = candidates.join(F.broadcast(instants), "_instant", "left_semi")
    on_end = candidates.join(closing, [key, "_instant"]).select(*fact.columns, *values)
    return inside.unionByName(on_end)


def point_in_time_overlapping(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    values: Sequence[str],
    start: str = "valid_from",
    end: str = "valid_to",
    closed: bool = False,
    days: int = 90,
) -> DataFrame:
    """The same join where versions of a key may overlap: a fact meets every version valid at its time.

    Time is cut into bins of ``days``.  A version stands in every bin that it covers
    between the first and the last fact, a fact in the one that holds its time, and
    the two meet on (key, bin): each pair is found once, and facts of a hot key are spread
    over its bins.  On histories without overlaps the join costs facts + version bins.
    """
    usable = fact.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    moment = F.col(ts).cast("timestamp_ntz")

    def place(time) -> Column:
        return F.floor(F.date_diff(F.to_date(time), F.lit("1970-01-01").cast("date")) / F.lit(days)).cast("int")

    first, last = usable.agg(F.min(place(moment)), F.max(place(moment))).first()
    bounds = dim.select(
        F.col(key), F.col(start).cast("timestamp_ntz").alias("_from"),
        F.coalesce(F.col(end).cast("timestamp_ntz"), open_end()).alias("_to"), *values)
    low = F.greatest(place("_from"), F.lit(0 if first is None else first))
    high = F.least(place("_to"), F.lit(-1 if last is None else last))
    placed = bounds.withColumns({"_low": low, "_high": high}).filter("_low <= _high").withColumn(
        "_bin", F.explode(F.sequence("_low", "_high")))
    inside = (moment >= F.col("_from")) & ((moment <= F.col("_to")) if closed else (moment < F.col("_to")))
    found = usable.withColumn("_bin", place(moment)).join(placed, [key, "_bin"])
    return found.filter(inside).select(*fact.columns, *values)


def snapshot_as_of_join(
    fact: DataFrame, snapshot: DataFrame, key: str, values: Sequence[str]
) -> DataFrame:
    """Facts joined to the current rows of an earlier snapshot of the dimension."""
    current = snapshot.filter(F.col("is_current")).select(key, *values)
    return fact.join(current, key)


def leakage_audit(
    fact: DataFrame, dim: DataFrame, key: str, ts: str, seconds: int = DAY
) -> DataFrame:
    """How far a join without upper bound strays from the point-in-time join.

    ``lower_bound_rows`` is the row count of joining on ``start <= ts`` alone,
    ``leaked_rows`` its surplus over the correct join, and ``future_rows`` the
    facts older than the version that is current now.  Facts of one key and time are
    counted before they meet the versions.
    """
    usable = fact.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    usable = stored(usable.groupBy(key, ts).agg(F.count(F.lit(1)).alias("_facts")), "audited-facts")
    versions = dim.withColumn("valid_to", F.coalesce(F.col("valid_to"), open_end()))
    found = last_version(
        usable, versions, key, ts, "valid_from", ["valid_to"], seen="_seen", seconds=seconds
    )
    current = (
        splittable_groups(dim.filter(F.col("is_current")), key)
        .agg(F.max("valid_from").alias("_current_from"))
        .drop("_group_hash")
    )
    moment = F.col(ts).cast("timestamp_ntz")

    def facts(number) -> Column:
        return F.coalesce(F.sum(number), F.lit(0)).cast("long")

    counts = found.join(current, key, "left").agg(
        facts(F.col("_facts")).alias("fact_rows"),
        facts(F.col("_facts") * F.col("_seen")).alias("lower_bound_rows"),
        facts(F.when(moment < F.col("_version.valid_to"), F.col("_facts"))).alias("correct_rows"),
        facts(F.when(moment < F.col("_current_from"), F.col("_facts"))).alias("future_rows"),
    )
    return counts.withColumn("leaked_rows", F.col("lower_bound_rows") - F.col("correct_rows"))
