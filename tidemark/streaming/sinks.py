"""Starting streams: append to a table, or upsert totals per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.money import TOTAL
from tidemark.operators.keys import distinct_keys, first_per_key
from tidemark.session import stored
from tidemark.sinks.tables import read_if_exists


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append to the table at ``path``.

    Without ``every`` the query takes what is available and stops; with it
    ("5 minutes") it keeps running.  The checkpoint lets a restart continue
    where the last run ended, without loss or repetition.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start(path)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run over what is available, wait, and read the table back."""
    append_stream(stream, path, checkpoint).awaitTermination()
    spark = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(path)


def run_counted(stream: DataFrame, path: str, checkpoint: str) -> tuple[DataFrame, int]:
    """Run over what is available; the table, and how many rows the watermark dropped in this run.

    Counted by the stateful operators of every batch.  Deduplication counts rows; an
    aggregate counts what reaches it, which is one row per task and group.  A run of more
    batches than the session keeps reports of is refused, rather than counted in part.
    """
    query = append_stream(stream, path, checkpoint)
    query.awaitTermination()
    spark = stream.sparkSession
    reports = query.recentProgress
    if len(reports) >= int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")):
        raise ValueError("raise spark.sql.streaming.numRecentProgressUpdates: reports of early batches are gone")
    dropped = sum(state["numRowsDroppedByWatermark"] for report in reports for state in report["stateOperators"])
    return spark.read.schema(stream.schema).parquet(path), dropped


class ValidatedSink:
    """Good and quarantined rows of a stream, from one pass over each micro-batch.

    ``flag`` marks a batch's rows with ``_ok``.  A batch is one write of the folder
    ``_batch=n``, its good and bad rows parted by ``_ok``: either both are there or neither,
    and a batch that is repeated after a failure replaces its own folder only.  Good
    rows are kept once per ``key``: the least of a batch, unless an earlier batch has the key;
    only batches' rows from ``days`` before the batch's oldest time are looked at.
    """

    def __init__(self, path: str, flag: Callable[[DataFrame], DataFrame], key: str, ts: str, days: int = 1):
        self.path, self.flag, self.key, self.ts, self.days = path, flag, key, ts, days

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        flagged = stored(self.flag(batch), "flagged")
        good, bad = flagged.filter("_ok"), flagged.filter("NOT _ok")
        fresh = first_per_key(good, [self.key])
        known = read_if_exists(spark, self.path)
        if known is not None:
            oldest = good.agg(F.min(self.ts)).first()[0]
            earlier = known.filter((F.col("_batch") < batch_id) & F.col("_ok"))
            if oldest is not None:
                earlier = earlier.filter(F.col(self.ts) >= F.lit(oldest) - F.make_dt_interval(F.lit(self.days)))
            fresh = fresh.join(distinct_keys(earlier, self.key), self.key, "left_anti").select(*good.columns)
        both = fresh.unionByName(bad)
        both.write.mode("overwrite").partitionBy("_ok").parquet(f"{self.path}/_batch={batch_id}")

    def read(self, spark: SparkSession, ok: bool) -> DataFrame:
        """The good rows, or the quarantined ones; only their folders are read."""
        return spark.read.parquet(self.path).filter(F.col("_ok") == F.lit(ok)).drop("_batch", "_ok")


def validate_stream(stream: DataFrame, sink: ValidatedSink, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Validate micro-batches into the sink; without ``every``, over what is available."""
    writer = stream.writeStream.foreachBatch(sink.write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


class TotalsTable:
    """Running totals in one folder per value of the first key (or of ``part``); a batch rewrites only those it touches.

    Each such part has two slots.  Batch ``n`` adds to the part's newest state before
    ``n`` and writes the other slot: a batch repeated after a failure, even one that
    got through for some parts only, starts from the same states and overwrites its
    own slots, so every row counts once, and the number of folders does not grow with
    the batches.  A batch below the newest state (a new checkpoint on old totals) is
    refused: it would be counted in nobody's totals.
    """

    def __init__(self, path: str, keys: Sequence[str], sums: Sequence[str], part: Column | None = None):
        self.path, self.keys, self.sums = path, list(keys), list(sums)
        self.part = F.col(self.keys[0]) if part is None else part

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        states = read_if_exists(batch.sparkSession, self.path)
        newest = None if states is None else states.agg(F.max("_batch")).first()[0]
        if newest is not None and newest > batch_id:
            raise ValueError(f"batch {batch_id} after batch {newest}: the checkpoint is not that of these totals")
        part = F.coalesce(F.concat(F.lit("v"), self.part.cast("string")), F.lit("null"))
        sums = [F.sum(c).cast(TOTAL if kind.startswith("decimal") else kind).alias(c)
                for c, kind in batch.dtypes if c in self.sums]
        totals = batch.groupBy(*self.keys).agg(*sums).withColumn("_part", part)
        slot = F.lit(0)
        if states is not None:
            known = states.filter(F.col("_batch") < batch_id).join(totals.select("_part").distinct(), "_part", "left_semi")
            last = self._last(known)
            before = self._current(known, last).select(*totals.columns)
            totals = totals.unionByName(before).groupBy("_part", *self.keys).agg(*sums).join(last, "_part", "left")
            slot = F.coalesce(1 - F.col("_last._slot"), slot)
        totals = totals.select("_part", *self.keys, *self.sums, F.lit(batch_id).cast("long").alias("_batch"), slot.alias("_slot"))
        writer = totals.hint("rebalance", "_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_part", "_slot").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The newest state of every part, or None before the first batch."""
        states = read_if_exists(spark, self.path)
        return None if states is None else self._current(states, self._last(states)).select(*self.keys, *self.sums)

    @staticmethod
    def _last(states: DataFrame) -> DataFrame:
        """_part, _last (batch and slot of its newest state)."""
        return states.groupBy("_part").agg(F.max(F.struct("_batch", "_slot")).alias("_last"))

    @staticmethod
    def _current(states: DataFrame, last: DataFrame) -> DataFrame:
        return states.join(last, "_part").filter(F.col("_slot") == F.col("_last._slot"))


def upsert_stream(
    stream: DataFrame, totals: TotalsTable, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Fold each micro-batch into the totals (e.g. daily revenue every 5 minutes)."""
    writer = stream.writeStream.foreachBatch(totals.upsert).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
