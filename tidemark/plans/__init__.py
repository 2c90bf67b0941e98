"""Registered queries over the parquet tables, each with an independent SQL oracle."""

from tidemark.plans import (  # noqa: F401  (imported for registration)
    gold,
    ingest,
    joins,
    merges,
    quality,
    rows,
    streams,
    versions,
)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
