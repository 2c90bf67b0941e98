"""Batch and incremental file readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import broadcast_if_small
from tidemark.sources import schemas
from tidemark.sources.literals import inline_regions


class SchemaMismatch(ValueError):
    """A file's columns do not fit the declared layout."""


def csv_scan(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """CSV with header and a declared schema, plus ``_ingested_at``.

    CSV columns are read by position.  ``strict`` has every file's header checked
    against the schema, so a moved or renamed column fails instead of landing
    under the wrong name.
    """
    reader = spark.read.option("header", True).option("enforceSchema", not strict)
    return reader.schema(schema).csv(path).withColumn("_ingested_at", F.current_timestamp())


def csv_scan_lineage(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As :func:`csv_scan`, plus ``_source_file``."""
    return csv_scan(spark, path, schema).withColumn("_source_file", F.col("_metadata.file_path"))


def evolve(old: DataFrame, new: DataFrame, hints: Mapping[str, str] | None = None) -> DataFrame:
    """Old and new layout together: added columns are NULL in old rows.

    ``hints`` give the type of new columns, e.g. ``{"lifetime_value": "decimal(12,2)"}``.
    """
    for column, kind in (hints or {}).items():
        if column in new.columns:
            new = new.withColumn(column, F.col(column).try_cast(kind))
    return old.unionByName(new, allowMissingColumns=True)


def require_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    """The frozen-schema mode: any added or missing column is an error."""
    if sorted(df.columns) != sorted(expected):
        raise SchemaMismatch(f"expected columns {sorted(expected)}, found {sorted(df.columns)}")
    return df


def csv_increments(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the files below ``path`` that the query's checkpoint has not seen."""
    stream = (
        spark.readStream.option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(schema)
        .csv(path)
    )
    return stream.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def parquet_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """Stream of a parquet table; ``path`` names one file or a folder of files.

    A stream takes a single file only by a pattern; this one matches nothing but ``path``.
    """
    path = path.rstrip("/")
    exact = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).schema(schema).parquet(exact)


def load_regions(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Region reference rows, marked for broadcast when measured small.

    Without a path: the built-in delivery regions, whose time zone is unknown.
    """
    if path is None:
        rows = inline_regions(spark).select(
            F.col("region_id").alias("region_code"),
            "region_name",
            F.col("country_code").alias("country"),
            F.lit(None).cast("string").alias("timezone"),
        )
    else:
        rows = spark.read.option("header", True).schema(schemas.REGIONS).csv(path)
    return broadcast_if_small(rows)


def load_categories(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Category reference rows with a boolean ``is_seasonal``, marked for broadcast when small.

    Without a path: no categories are known yet, an empty table of the same columns.
    """
    if path is None:
        rows = spark.createDataFrame([], schemas.CATEGORIES)
        return rows.withColumn("is_seasonal", F.col("is_seasonal").try_cast("boolean"))
    rows = spark.read.option("header", True).schema(schemas.CATEGORIES).csv(path)
    return broadcast_if_small(rows.withColumn("is_seasonal", F.col("is_seasonal").try_cast("boolean")))
