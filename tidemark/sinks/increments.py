"""Change loads that resume where the last one ended.

``<path>/staged/load=n`` holds the changes that load n read, ``<path>/state`` the newest
change of every key (deletes included, so that an older change that arrives late cannot
bring a key back), and ``<path>/marks`` the highest sequence number of every finished
load.  The mark is written last: a load that failed anywhere before is repeated from the
old mark, and as the newest change per key wins, repeating it changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import latest_per_key
from tidemark.sinks.tables import create_or_merge, read_if_exists


class ResumableLoad:
    """``late`` is how far below the mark sequence numbers may still arrive (a number or an interval)."""

    def __init__(self, spark: SparkSession, path: str, key: str, seq: str, op: str = "op", late: Column | int | None = None, buckets: int = 64):
        self.spark, self.path, self.key, self.seq, self.op, self.late, self.buckets = spark, path, key, seq, op, late, buckets

    def mark(self) -> object | None:
        """The highest sequence number of the finished loads."""
        marks = read_if_exists(self.spark, f"{self.path}/marks")
        return None if marks is None else marks.agg(F.max("high")).first()[0]

    def load(self, source: DataFrame) -> int:
        """Read what is new in ``source`` (all of it the first time); returns the number of changes read."""
        staged = self.stage(source)
        n = staged.count()
        if n:
            self.apply(staged)
            self.finish(staged)
        return n

    def stage(self, source: DataFrame) -> DataFrame:
        """The changes above the mark, stored; the condition reaches the source's scan."""
        high = self.mark()
        rows = source.filter(F.col(self.key).isNotNull() & F.col(self.seq).isNotNull())
        if high is not None:
            floor = F.lit(high) if self.late is None else F.lit(high) - self.late
            rows = rows.filter(F.col(self.seq) > floor)
        marks = read_if_exists(self.spark, f"{self.path}/marks")
        folder = f"{self.path}/staged/load={0 if marks is None else marks.count()}"
        rows.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def apply(self, staged: DataFrame) -> None:
        """The newest change of every key, stored or staged, becomes its state."""

        def newest(before: DataFrame | None, log: DataFrame) -> DataFrame:
            both = log if before is None else before.select(*log.columns).unionByName(log)
            return latest_per_key(both, [self.key], [self.seq])

        create_or_merge(staged, f"{self.path}/state", self.key, newest, self.buckets)

    def finish(self, staged: DataFrame) -> None:
        staged.agg(F.max(self.seq).alias("high")).coalesce(1).write.mode("append").parquet(f"{self.path}/marks")

    def read(self, delete: str = "delete") -> DataFrame:
        """The rows that are alive."""
        state = self.spark.read.parquet(f"{self.path}/state").filter(F.col(self.key).isNotNull())
        alive = state.filter(~F.col(self.op).eqNullSafe(F.lit(delete)))
        return alive.drop(self.op, self.seq, *[c for c in state.columns if c.startswith("_bucket")])
