"""File layout jobs: compaction, Z-order, file report.  Rows never change."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows (about) from which the boundaries of a Z order are taken, whatever the table's size.
SAMPLE_ROWS = 20_000
MEGABYTE = 1024 * 1024


def file_report(df: DataFrame) -> DataFrame:
    """Rows and bytes per file of a file-based table."""
    return df.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def files_for(df: DataFrame, target_mb: int = 128) -> int:
    """How many files of the target size hold the table, from the bytes it uses now."""
    size = file_report(df).agg(F.sum("bytes")).first()[0] or 0
    return max(1, -(-size // (target_mb * MEGABYTE)))


def compact_files(
    spark: SparkSession, source: str, target: str, files: int | None = None, target_mb: int = 128
) -> DataFrame:
    """Rewrite a table of many small files as few even ones of about ``target_mb``."""
    table = spark.read.parquet(source)
    count = files_for(table, target_mb) if files is None else files
    table.repartition(count).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


@dataclass
class Packed:
    """A compacted table: files kept as they are, and the folder of packed ones."""

    spark: SparkSession
    kept: list[str]
    folder: str | None

    def read(self) -> DataFrame:
        paths = [*self.kept, *([self.folder] if self.folder else [])]
        return self.spark.read.parquet(*paths)


def pack_files(
    spark: SparkSession, source: str, target: str, target_mb: float = 128, sort: Sequence[str] = (), small: float = 0.5
) -> Packed:
    """Join the small files of a table into files of about ``target_mb``; large ones are neither read nor copied.

    Files below ``small`` times the target are packed in order of their names (of their
    least ``sort`` values, if given), so that neighbours stay together; each new file is
    sorted by ``sort``.  A single small file has nothing to be joined with and is kept.
    Files are listed by their sizes alone; only the list of names reaches the driver.
    """
    table = spark.read.parquet(source)
    limit = int(target_mb * MEGABYTE)
    report = file_report(table)
    is_small = F.col("bytes") < int(small * limit)
    few = [r.file for r in report.filter(is_small).select("file").collect()]
    kept = [r.file for r in report.filter(~is_small).select("file").collect()]
    if len(few) < 2:
        return Packed(spark, [*kept, *few], None)
    rows = spark.read.schema(table.schema).parquet(*few)
    first = [F.min(c).alias(f"_first_{n}") for n, c in enumerate(sort)]
    files = rows.groupBy(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_bytes")).agg(
        F.count(F.lit(1)).alias("_n"), *first)
    order = Window.orderBy(*[f"_first_{n}" for n in range(len(sort))], "_file")  # one row per small file
    before = F.sum("_bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    bins = files.select("_file", F.floor(F.coalesce(before, F.lit(0)) / limit).cast("int").alias("_bin"))
    n_bins = (bins.agg(F.max("_bin")).first()[0] or 0) + 1
    placed = rows.withColumn("_file", F.col("_metadata.file_path")).join(F.broadcast(bins), "_file").drop("_file")
    (
        placed.repartitionByRange(n_bins, "_bin").sortWithinPartitions("_bin", *sort).drop("_bin")
        .write.mode("overwrite").parquet(target)
    )
    return Packed(spark, kept, target)


def bits_for(files: int, columns: int) -> int:
    """Bits per column so that there are several cells to each file."""
    return min(10, max(4, -(-(max(files, 1) - 1).bit_length() // columns) + 2))


def boundaries(df: DataFrame, columns: Sequence[str], bits: int, rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """At most ``2**bits - 1`` values of each column that cut a sample of its rows into even parts.

    The values are compared as they are - text as text - so an odd value takes one
    place among the ranks and does not stretch a scale.
    """
    n = df.count()
    share = 1.0 if n <= rows else rows / n
    names = [f"c{k}" for k in range(len(columns))]
    picked = df.select(*[F.col(c).alias(k) for c, k in zip(columns, names, strict=True)])
    sample = (picked if share == 1.0 else picked.sample(share, seed=7)).collect()
    parts = 1 << bits
    found = {}
    for c, k in zip(columns, names, strict=True):
        known = sorted(r[k] for r in sample if r[k] is not None)
        cuts = [known[len(known) * i // parts] for i in range(1, parts)] if known else []
        found[c] = [v for i, v in enumerate(cuts) if i == 0 or v != cuts[i - 1]]
    return found


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> DataFrame:
    """``df`` with ``_z``, the interleaved bits of each column's rank among sampled boundaries.

    A row finds its rank in ``bits`` comparisons; nulls rank lowest.
    """
    edges = boundaries(df, columns, bits)
    ranked = df.withColumns({f"_rank_{n}": F.when(F.col(c).isNull(), F.lit(0)).otherwise(_bucket(F.col(c), edges[c]))
                             for n, c in enumerate(columns)})
    value = F.lit(0).cast("long")
    for position in range(len(columns)):
        for bit in range(bits):
            taken = F.shiftright(F.col(f"_rank_{position}"), bit).bitwiseAND(F.lit(1)).cast("long")
            value = value.bitwiseOR(F.shiftleft(taken, bit * len(columns) + position))
    return ranked.withColumn("_z", value).drop(*[f"_rank_{n}" for n in range(len(columns))])


def zorder(df: DataFrame, columns: Sequence[str], files: int, bits: int | None = None) -> DataFrame:
    """Rows near each other in all ``columns`` land in the same file.

    The number of cells follows the number of files.  The raw columns follow the Z value
    in the range key, so one crowded cell can still be cut into several files.
    """
    return (
        z_value(df, columns, bits_for(files, len(columns)) if bits is None else bits)
        .repartitionByRange(files, "_z", *columns)
        .sortWithinPartitions("_z", *columns)
        .drop("_z")
    )


def _bucket(value: Column, edges: list, first: int = 0) -> Column:
    """How many edges are <= ``value``, as a binary decision tree."""
    if not edges:
        return F.lit(first)
    middle = len(edges) // 2
    return F.when(value < F.lit(edges[middle]), _bucket(value, edges[:middle], first)).otherwise(
        _bucket(value, edges[middle + 1 :], first + middle + 1)
    )


def write_lookup(df: DataFrame, path: str, keys: Sequence[str], sort: Sequence[str], row_group_mb: float = 16) -> DataFrame:
    """A table for point lookups: sorted by ``sort``, with a Bloom filter per row group for each of ``keys``.

    Row groups are skipped by the least and greatest values of the sorted columns, and by
    the filter for a key that the sort does not bring together.
    """
    writer = df.repartitionByRange(*sort).sortWithinPartitions(*sort).write.mode("overwrite")
    writer = writer.option("parquet.block.size", int(row_group_mb * MEGABYTE))
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def rows_scanned(df: DataFrame) -> int:
    """Rows that the file scans of an executed plan gave out, after row groups were skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = [leaves.apply(i).metrics().get("numOutputRows") for i in range(leaves.size())]
    return sum(m.get().value() for m in found if m.isDefined())
