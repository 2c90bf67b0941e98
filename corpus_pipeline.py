"""Corpus pipeline: every stage is written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, secrets, simhash, toxicity
from tidemark.llm.queries import table
from tidemark.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.fit(*toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.ordinary(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of four-word shingles at 4 or fewer bits: the smallest id."""
    return simhash.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources come near their target weights."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: Toxicity scores and mixing draws have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
