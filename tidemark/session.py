"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MEGABYTE = 1024 * 1024


def build_session(app: str = "tidemark", master: str | None = None, **conf: object) -> SparkSession:
    """A session with UTC time, adaptive execution and skew-join splitting on."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    configure_aqe(spark)
    return spark


def enable_skew_splitting(spark: SparkSession) -> None:
    """Re-planning at run time: coalesce small partitions, split skewed ones.

    Splitting is forced: a join whose result must keep its key partitioning is
    still split, at the price of one more shuffle, when a key really is hot.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # A union that keeps its inputs' partitioning zips their partitions, and fails once
        # re-planning has given one of them another number of partitions.
        "spark.sql.unionOutputPartitioning": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)


def configure_aqe(spark: SparkSession, broadcast_threshold_mb: int = 10) -> None:
    """Adaptive settings, and the size below which a join side is broadcast by itself."""
    enable_skew_splitting(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(broadcast_threshold_mb * MEGABYTE))


def size_shuffles(spark: SparkSession, input_bytes: int, partition_mb: int = 256) -> int:
    """Enough shuffle partitions for an input of this size; never fewer than set now.

    The adaptive planner merges partitions that turn out small, so the number is
    an upper bound, not a task count.
    """
    needed = -(-input_bytes // (partition_mb * MEGABYTE))
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), needed)
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count


def bound_tasks(spark: SparkSession, input_bytes: int, partition_mb: int = 8) -> int:
    """Enough, and small enough, tasks that what one holds does not grow with the input.

    The first number of partitions of re-planned shuffles follows the input; what the
    planner merges again, and what a task scans, stays below bounds that are lowered, never
    raised.  Sorted rows take some ten to fifty times their compressed shuffle bytes.  Streams
    are not re-planned and keep ``spark.sql.shuffle.partitions``.
    """
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // (partition_mb * MEGABYTE)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(count))
    for key, most in (("adaptive.advisoryPartitionSizeInBytes", 4), ("files.maxPartitionBytes", 32)):
        now = _bytes(spark.conf.get(f"spark.sql.{key}"))
        spark.conf.set(f"spark.sql.{key}", str(min(now, most * MEGABYTE)))
    return count


def _bytes(size: str) -> int:
    """A size as Spark settings write it: ``64m``, ``64MB`` or plain bytes."""
    digits = size.strip().lower().rstrip("bkmgtpi")
    unit = size.strip().lower()[len(digits):][:1]
    return int(digits) << 10 * "bkmgtp".index(unit or "b")


def use_disk_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB instead of executor memory.

    For dedup windows and open days that hold many keys.  Set it, and the number
    of shuffle partitions, before a stream's first start: both are fixed by its
    checkpoint.
    """
    package = "org.apache.spark.sql.execution.streaming.state"
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass", f"{package}.RocksDBStateStoreProvider"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset (as in tests) the session's warehouse location serves: it
    is shared between driver and executors too, unlike a machine's own folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    For a result that a plan uses several times: it is computed once, and lost
    executors cost a reread instead of the work behind it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
