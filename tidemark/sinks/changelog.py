"""Tables whose writes leave a change log, and whose versions are a base plus that log.

``<path>/base/version=n`` holds full states, the first and then one every
``base_every`` versions; ``<path>/changes/_commit_version=n`` holds the rows that
version n changed, each with its kind (insert, update_preimage, update_postimage,
delete); ``<path>/history`` has one row per version and is written last, so a commit
that failed half-way is invisible and its repetition overwrites it.

A write costs its changed rows: an append writes what it is given, a merge compares
its source with the stored rows of the same keys, a restore writes back what later
versions changed.  A reader of the feed opens the folders of the versions it asks for
and no others.  A state is its base without the keys that the log replaced, plus the
log's newer rows; rows with a null key are only ever added.

A merge takes each key once, in the table and in the source.  A delete takes all rows
of the keys it names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import AFTER, BEFORE, DELETE, INSERT, change_feed
from tidemark.operators.keys import distinct_keys, latest_per_key
from tidemark.operators.validation import RowCountError
from tidemark.sinks.tables import read_if_exists

HISTORY = "version LONG, committed_at TIMESTAMP_NTZ, operation STRING, row_count LONG, changed_rows LONG, base_version LONG"
KIND, VERSION, TIME = "_change_type", "_commit_version", "_commit_timestamp"


class ChangeTable:
    def __init__(self, spark: SparkSession, path: str, key: str, base_every: int = 16):
        self.spark, self.path, self.key, self.base_every = spark, path, key, base_every

    # --- reading

    def history(self) -> DataFrame:
        """Number, time, operation, row count, changed rows and base of every version."""
        found = read_if_exists(self.spark, f"{self.path}/history")
        return self.spark.createDataFrame([], HISTORY) if found is None else found

    def find(self, version: int | None = None, ts: object = None, after: object = None, before: object = None) -> Row | None:
        """The newest version that is within the given bounds."""
        log, at = self.history(), F.col("committed_at")
        bounds = [
            (version, lambda v: F.col("version") <= v),
            (ts, lambda t: at <= F.lit(t).cast("timestamp_ntz")),
            (after, lambda t: at > F.lit(t).cast("timestamp_ntz")),
            (before, lambda t: at < F.lit(t).cast("timestamp_ntz")),
        ]
        for value, condition in bounds:
            if value is not None:
                log = log.filter(condition(value))
        return log.orderBy(F.desc("version")).first()

    def as_of(self, version: int | None = None, ts: object = None) -> DataFrame:
        """The rows as of a version number and/or a time; before the first version, no rows."""
        entry = self.find(version, ts)
        if entry is None:
            return self._base(0).limit(0)
        base = self._base(entry.base_version)
        if entry.version == entry.base_version:
            return base
        log = self._log(entry.base_version + 1, entry.version)
        removed = log.filter(F.col(KIND).isin(BEFORE, DELETE))
        if removed.isEmpty():  # files' statistics tell; a log of appends needs no join
            return base.unionByName(log.filter(F.col(KIND).isin(INSERT, AFTER)).select(*base.columns))
        replaced = removed.groupBy(F.col(self.key).alias("_replaced")).agg(F.max(VERSION).alias("_at"))
        same = F.col(self.key) == F.col("_replaced")
        newer = F.col("_at").isNull() | (F.col(VERSION) > F.col("_at")) | ((F.col(VERSION) == F.col("_at")) & (F.col(KIND) == AFTER))
        written = log.filter(F.col(KIND).isin(INSERT, AFTER)).join(replaced, same, "left").filter(newer)
        return base.join(replaced, same, "left_anti").unionByName(written.select(*base.columns))

    def changes(self, since: int = 0, until: int | None = None, ts: object = None) -> DataFrame:
        """The feed from version ``since`` to ``until``, or from time ``ts`` on, as the writes left it.

        The first version is a full write: its rows are inserts.
        """
        if ts is not None:
            first = self.history().filter(F.col("committed_at") >= F.lit(ts).cast("timestamp_ntz")).agg(F.min("version")).first()[0]
            since = max(since, self._next() if first is None else first)
        last = self.find(until)
        feed = self._log(max(since, 1), -1 if last is None else last.version)
        if since > 0 or last is None:
            return feed
        first = self.find(0)
        rows = self._base(0).withColumns(
            {KIND: F.lit(INSERT), TIME: F.lit(first.committed_at).cast("timestamp_ntz"), VERSION: F.lit(0).cast("long")})
        return rows.unionByName(feed)

    def _base(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/base/version={version}")

    def _log(self, since: int, until: int) -> DataFrame:
        """Change rows of versions ``since`` to ``until``; the bounds select folders."""
        columns = self._base(0).schema
        fields = columns.add(KIND, "string").add(TIME, "timestamp_ntz").add(VERSION, "long")
        if self._next() <= 1:
            return self.spark.createDataFrame([], fields)
        return self.spark.read.schema(fields).parquet(f"{self.path}/changes").filter(F.col(VERSION).between(since, until))

    # --- writing

    def write(self, df: DataFrame, committed_at: str, operation: str = "WRITE") -> int:
        """The first version: a full state."""
        if self._next():
            raise ValueError(f"{self.path} has versions already")
        df.write.mode("overwrite").parquet(f"{self.path}/base/version=0")
        return self._record(0, operation, self._base(0).count(), None, 0, committed_at)

    def append(self, df: DataFrame, committed_at: str, operation: str = "APPEND") -> int:
        """Add rows; nothing that is stored is read."""
        return self._commit(df.withColumn(KIND, F.lit(INSERT)), operation, committed_at)

    def merge(self, source: DataFrame, committed_at: str, delete: DataFrame | None = None, operation: str = "MERGE") -> int:
        """Insert or replace the rows of ``source`` and remove the keys of ``delete``.

        Of source rows that share a key the greatest counts; rows without a key are left
        out.  Stored rows of other keys are not compared, and equal rows leave no change.
        """
        columns = self._base(0).columns
        after = latest_per_key(source.select(*columns).dropna(subset=[self.key]), [self.key], [])
        if delete is not None:
            after = after.join(distinct_keys(delete, self.key), self.key, "left_anti")
        named = after.select(self.key) if delete is None else after.select(self.key).unionByName(delete.select(self.key))
        before = self.as_of().join(distinct_keys(named, self.key), self.key, "left_semi")
        feed = change_feed(before, after, self.key).drop(VERSION, TIME)
        return self._commit(feed, operation, committed_at)

    def delete(self, condition: Column, committed_at: str, operation: str = "DELETE") -> int:
        """Remove every key that has a row for which ``condition`` holds."""
        state, holds = self.as_of(), F.coalesce(condition, F.lit(False))
        gone, others = state.filter(holds & F.col(self.key).isNotNull()), state.filter(~holds)
        if not others.isEmpty():  # other rows of the same keys
            gone = gone.unionByName(others.join(distinct_keys(gone, self.key), self.key, "left_semi").select(*state.columns))
        return self._commit(gone.withColumn(KIND, F.lit(DELETE)), operation, committed_at)

    def restore(self, committed_at: str, version: int | None = None, after: object = None, before: object = None, min_rows: int = 1) -> int:
        """Make an earlier version the newest again, by writing back what later versions changed.

        Chosen by number or as the last one of the open range (after, before).  Raises before
        anything is written when that version has under ``min_rows`` rows.
        """
        entry = self.find(version, after=after, before=before)
        if entry is None:
            raise ValueError(f"no version between {after} and {before}")
        if entry.row_count < min_rows:
            raise RowCountError(f"version {entry.version} has {entry.row_count} rows, expected at least {min_rows}")
        touched = distinct_keys(self._log(entry.version + 1, self._next() - 1), self.key)
        now, then = (state.join(touched, self.key, "left_semi") for state in (self.as_of(), self.as_of(entry.version)))

        def marked(rows, others, both, alone):
            kept = distinct_keys(others, self.key).withColumn("_both", F.lit(True))
            kind = F.when(F.col("_both"), both).otherwise(alone)
            return rows.join(kept, self.key, "left").withColumn(KIND, kind).drop("_both")

        feed = marked(now, then, BEFORE, DELETE).unionByName(marked(then, now, AFTER, INSERT))
        return self._commit(feed, "RESTORE", committed_at)

    def _commit(self, feed: DataFrame, operation: str, committed_at: str) -> int:
        last = self.find()
        if last is None:
            raise ValueError(f"{self.path} has no first version")
        version = last.version + 1
        columns = [*self._base(0).columns, KIND]
        folder = f"{self.path}/changes/{VERSION}={version}"
        stamped = feed.select(*columns, F.lit(committed_at).cast("timestamp_ntz").alias(TIME))
        stamped.write.mode("overwrite").parquet(folder)
        counts = dict(self.spark.read.parquet(folder).groupBy(KIND).count().collect())
        added = sum(counts.get(k, 0) for k in (INSERT, AFTER)) - sum(counts.get(k, 0) for k in (BEFORE, DELETE))
        base = last.base_version
        self._record(version, operation, last.row_count + added, sum(counts.values()), base, committed_at)
        if version - base >= self.base_every:
            self.rebase()
        return version

    def rebase(self) -> int:
        """Write the newest state as a base, so that later reads start from it; returns its version."""
        entry = self.find()
        if entry.base_version != entry.version:
            self.as_of().write.mode("overwrite").parquet(f"{self.path}/base/version={entry.version}")
            self._record(entry.version + 1, "REBASE", entry.row_count, 0, entry.version, str(entry.committed_at))
        return entry.version

    def _next(self) -> int:
        last = self.find()
        return 0 if last is None else last.version + 1

    def _record(self, version: int, operation: str, rows: int, changed: int | None, base: int, committed_at: str) -> int:
        at = F.lit(committed_at).cast("timestamp_ntz")
        row = self.spark.createDataFrame([(version, None, operation, rows, changed, base)], HISTORY).withColumn("committed_at", at)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/history")
        return version
