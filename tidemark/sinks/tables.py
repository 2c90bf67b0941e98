"""Writers.  All of them are safe to run again after a lost executor or a failed job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"
BUCKETS = "_buckets"
BUCKET_MB = 1024
BUCKETS_AT_LEAST = 256


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """Write a catalog table, creating its namespace; replacing may change the schema."""
    spark = df.sparkSession
    if "." in name:
        ensure_namespace(spark, name.rsplit(".", 1)[0])
    writer = df.write.format("parquet").mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """A catalog table whose rows lie in buckets of ``key``, sorted by it within each file.

    Grouping by the key, and joining tables of as many buckets, needs no shuffle.  The
    rows of a bucket are one task's work when it is read that way; a key with a large share
    of all rows is better read from a table without buckets, where the shuffle combines
    first and the adaptive planner splits.  Rebalancing keeps the files per bucket few.
    """
    writer = df.hint("rebalance", F.col(key)).write.format("parquet").mode("overwrite")
    writer.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_table(df: DataFrame, path: str) -> DataFrame:
    """Replace all rows and the schema at ``path``.

    A table cannot replace itself while it is read: write the next version
    (see ``versions.commit``) in that case.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append_table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def create_or_merge(
    source: DataFrame,
    path: str,
    key: str,
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    buckets: int | None = None,
) -> DataFrame:
    """First run: the source's initial state.  Later runs: merge into the table in place.

    Rows live in hash buckets of the key.  Only buckets that the source touches
    are read and rewritten (staged, then swapped in), so a small load costs its
    buckets and not the table.  ``merge`` must give the same result when it is
    repeated, as the upserts of this package do for a fixed ``as_of``.  A bucket that a merge
    empties keeps one row without a key, so that it is rewritten too; such rows are never read.
    The number of buckets is part of the table: chosen when it is created (one per
    ``BUCKET_MB`` of the first source, ``BUCKETS_AT_LEAST`` at least), kept from then on, and
    another one is refused.
    """
    spark = source.sparkSession
    table = read_if_exists(spark, path)
    known = None if table is None else table.filter(F.col(BUCKETS).isNotNull()).select(BUCKETS).first()
    if known is not None and buckets not in (None, known[0]):
        raise ValueError(f"the table has {known[0]} buckets, not {buckets}")
    if known is not None:
        buckets = known[0]
    elif buckets is None:
        size = int(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
        buckets = max(BUCKETS_AT_LEAST, min(-(-size // (BUCKET_MB << 20)), 1 << 20))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    emptied = None
    if table is None:
        state = merge(None, source)
    else:
        touched = [row[0] for row in source.select(bucket).distinct().collect()]  # at most ``buckets``
        before = table.filter(F.col(BUCKET).isin(touched) & F.col(key).isNotNull()).drop(BUCKET, BUCKETS)
        state = merge(before, source)
        emptied = spark.createDataFrame([(n,) for n in touched], f"{BUCKET} int")
    placed = state.withColumn(BUCKET, bucket)
    if emptied is not None:
        placed = placed.unionByName(emptied, allowMissingColumns=True)
    (
        placed.withColumn(BUCKETS, F.lit(buckets))
        .hint("rebalance", F.col(BUCKET))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )
    return spark.read.parquet(path).filter(F.col(key).isNotNull()).drop(BUCKET, BUCKETS)


def write_partitioned(df: DataFrame, path: str, ts: str, column: str = "_partition_date") -> DataFrame:
    """Partition by the date of ``ts`` so date filters skip folders.

    ``rebalance`` puts a date's rows together and splits a date that outgrows
    the advisory partition size, so one heavy day is not one task.
    """
    dated = df.withColumn(column, F.to_date(ts))
    dated.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_validated(flagged: DataFrame, path: str) -> DataFrame:
    """Good and bad rows in one pass, as the two partitions ``_ok=true`` and ``_ok=false``."""
    flagged.write.mode("overwrite").partitionBy("_ok").parquet(path)
    return flagged.sparkSession.read.parquet(path)


def write_quarantine(bad: DataFrame, path: str) -> bool:
    """Write bad rows with their load time, only if there are any."""
    if bad.isEmpty():
        return False
    bad.withColumn("_loaded_at", F.current_timestamp()).write.mode("overwrite").parquet(path)
    return True


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with header, a file per task; ``files=1`` asks for a single one (of a small table)."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").option("header", True).csv(path)


def shared_view(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What leaves the house: the allow-listed columns only."""
    return df.select(*columns)
