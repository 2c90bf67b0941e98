"""Table versions: one data folder per written version and a small history table.

``<path>/data/version=n`` holds the rows, ``<path>/history`` one row per version:
its number, time, operation, row count, and the version whose folder holds its
rows (another one after a restore, which copies nothing).  The history row is
written last, so a version exists only when its data is complete, and finding a
version never touches the data of the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.validation import RowCountError
from tidemark.sinks.tables import read_if_exists

HISTORY = "version LONG, committed_at TIMESTAMP_NTZ, operation STRING, row_count LONG, data_version LONG"


def version_history(spark: SparkSession, path: str) -> DataFrame:
    """Number, time, operation and row count of every version."""
    found = read_if_exists(spark, f"{path}/history")
    return spark.createDataFrame([], HISTORY) if found is None else found


def commit(df: DataFrame, path: str, operation: str, committed_at: str) -> int:
    """Write ``df`` as the next version; rows are counted from the written file footers.

    A commit that failed half-way left no history row; its repetition takes the
    same number and overwrites the partial folder.
    """
    spark = df.sparkSession
    version = _next_version(spark, path)
    df.write.mode("overwrite").parquet(_folder(path, version))
    rows = spark.read.parquet(_folder(path, version)).count()
    _record(spark, path, (version, None, operation, rows, version), committed_at)
    return version


def find_version(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    ts: object = None,
    after: object = None,
    before: object = None,
) -> int | None:
    """The newest version with number <= ``version``, time <= ``ts``, and inside
    the open range (``after``, ``before``) - whichever of these are given."""
    log = version_history(spark, path)
    at = F.col("committed_at")
    bounds = [
        (version, lambda v: F.col("version") <= v),
        (ts, lambda t: at <= F.lit(t).cast("timestamp_ntz")),
        (after, lambda t: at > F.lit(t).cast("timestamp_ntz")),
        (before, lambda t: at < F.lit(t).cast("timestamp_ntz")),
    ]
    for value, condition in bounds:
        if value is not None:
            log = log.filter(condition(value))
    return log.agg(F.max("version")).first()[0]


def as_of_version(
    spark: SparkSession, path: str, version: int | None = None, ts: object = None
) -> DataFrame:
    """The table as of a version number and/or a time; before the first version, no rows."""
    found = find_version(spark, path, version, ts)
    if found is None:
        return spark.read.parquet(_folder(path, 0)).limit(0)
    return spark.read.parquet(_folder(path, _entry(spark, path, found)["data_version"]))


def restore(
    spark: SparkSession, path: str, after: str, before: str, committed_at: str, min_rows: int = 1
) -> int:
    """Make the last version from the open range (after, before) the newest again.

    Raises before anything is written when that version has under ``min_rows`` rows.
    """
    chosen = find_version(spark, path, after=after, before=before)
    if chosen is None:
        raise ValueError(f"no version between {after} and {before}")
    entry = _entry(spark, path, chosen)
    if entry["row_count"] < min_rows:
        raise RowCountError(
            f"version {chosen} has {entry['row_count']} rows, expected at least {min_rows}"
        )
    version = _next_version(spark, path)
    _record(spark, path, (version, None, "RESTORE", entry["row_count"], entry["data_version"]), committed_at)
    return version


def _next_version(spark: SparkSession, path: str) -> int:
    last = find_version(spark, path)
    return 0 if last is None else last + 1


def _entry(spark: SparkSession, path: str, version: int) -> Row:
    return version_history(spark, path).filter(F.col("version") == version).first()


def _record(spark: SparkSession, path: str, entry: tuple, committed_at: str) -> None:
    row = spark.createDataFrame([entry], HISTORY).withColumn(
        "committed_at", F.lit(committed_at).cast("timestamp_ntz")
    )
    row.coalesce(1).write.mode("append").parquet(f"{path}/history")


def _folder(path: str, version: int) -> str:
    return f"{path}/data/version={version}"
