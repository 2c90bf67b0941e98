"""Type-2 history: snapshot merge, change-log replay, integrity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import differs, row_hash
from tidemark.functions.times import moment, open_end
from tidemark.operators.keys import latest_per_key
from tidemark.operators.timeline import with_neighbour

VERSION_COLUMNS = ("row_hash", "is_current", "valid_from", "valid_to")


def scd2_apply(
    target: DataFrame | None,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    carried: Sequence[str],
    as_of: object,
) -> DataFrame:
    """The dimension after one snapshot load.

    Current and incoming rows meet in a single full join; each pair yields the
    kept row, or the expired row plus its successor.  Both bounds use ``as_of``,
    so versions neither gap nor overlap.  Keys missing from the source stay
    current; closed versions pass through without a join.
    """
    columns = [key, *carried, *tracked]
    incoming = latest_per_key(source.dropna(subset=[key]).select(*columns), [key], [])
    opened = incoming.select(
        *columns,
        row_hash(tracked).alias("row_hash"),
        F.lit(True).alias("is_current"),
        moment(as_of).alias("valid_from"),
        open_end().alias("valid_to"),
    )
    if target is None:
        return opened

    layout = opened.columns
    current = target.filter(F.col("is_current")).select(*layout)
    pairs = current.alias("t").join(opened.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    old = F.struct(*[F.col(f"t.{c}") for c in layout])
    new = F.struct(*[F.col(f"s.{c}") for c in layout])
    expired = F.struct(
        *[F.col(f"t.{c}") for c in [*columns, "row_hash"]],
        F.lit(False).alias("is_current"),
        F.col("t.valid_from"),
        moment(as_of).alias("valid_to"),
    )
    outcome = (
        F.when(F.col(f"t.{key}").isNull(), F.array(new))
        .when(F.col(f"s.{key}").isNull(), F.array(old))
        .when(differs("t", "s", tracked), F.array(expired, new))
        .otherwise(F.array(old))
    )
    merged = pairs.select(F.explode(outcome).alias("_row")).select("_row.*")
    closed = target.filter(~F.col("is_current")).select(*layout)
    return closed.unionByName(merged)


def apply_changes_scd2(
    log: DataFrame,
    key: str,
    seq: str,
    tracked: Sequence[str],
    op: str = "op",
    delete: str = "delete",
) -> DataFrame:
    """Complete history from a change log.

    Changes are ordered by ``seq`` (several at one ``seq``: the greatest row
    wins).  A change that repeats the tracked values of its predecessor opens no
    version; a delete closes the version before it.  Changes without a key are left out.
    """
    gone = F.col(op).eqNullSafe(F.lit(delete))
    changes = (
        latest_per_key(log.select(key, seq, op, *tracked).dropna(subset=[key]), [key, seq], [])
        .withColumn("_gone", gone)
        .drop(op)
    )
    compared = with_neighbour(
        changes, [key], [seq], ["_gone", *tracked], "_before", following=False
    )
    unchanged = F.col("_before").isNotNull() & (F.col("_before._gone") == F.col("_gone"))
    same_values = F.lit(True)
    for column in tracked:
        same_values = same_values & F.col(f"_before.{column}").eqNullSafe(F.col(column))
    leading_delete = F.col("_before").isNull() & F.col("_gone")
    kept = compared.filter(
        ~(F.coalesce(unchanged, F.lit(False)) & (F.col("_gone") | same_values)) & ~leading_delete
    ).drop("_before")
    bounded = with_neighbour(kept, [key], [seq], [seq], "_after", following=True)
    return bounded.filter(~F.col("_gone")).select(
        key,
        *tracked,
        F.col("_after").isNull().alias("is_current"),
        F.col(seq).cast("timestamp_ntz").alias("valid_from"),
        F.coalesce(F.col(f"_after.{seq}").cast("timestamp_ntz"), open_end()).alias("valid_to"),
    )


def price_history(feed: DataFrame, key: str, ts: str, values: Sequence[str]) -> DataFrame:
    """Interval view of an append-only feed: each row is valid until the next one."""
    once = latest_per_key(feed.select(key, ts, *values), [key, ts], [])
    bounded = with_neighbour(once, [key], [ts], [ts], "_after", following=True)
    return bounded.select(
        key,
        *values,
        F.col(ts).cast("timestamp_ntz").alias("valid_from"),
        F.coalesce(F.col(f"_after.{ts}").cast("timestamp_ntz"), open_end()).alias("valid_to"),
    )


def scd2_history(dim: DataFrame, key: str, value: object) -> DataFrame:
    """All versions of one key, oldest first."""
    return dim.filter(F.col(key) == F.lit(value)).orderBy("valid_from")


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def scd2_integrity(dim: DataFrame, key: str) -> DataFrame:
    """Per key that breaks the rules: current rows, overlaps and gaps.

    A sound key has exactly one current row and every version ends where the
    next one starts.
    """
    bounded = with_neighbour(
        dim.select(key, "is_current", "valid_from", "valid_to"),
        [key],
        ["valid_from", "valid_to"],
        ["valid_from"],
        "_after",
        following=True,
    )
    end = F.coalesce(F.col("valid_to"), open_end())
    report = bounded.groupBy(key).agg(
        F.count_if("is_current").alias("current_rows"),
        F.count_if(end > F.col("_after.valid_from")).alias("overlaps"),
        F.count_if(end < F.col("_after.valid_from")).alias("gaps"),
    )
    return report.filter("current_rows <> 1 OR overlaps > 0 OR gaps > 0")
