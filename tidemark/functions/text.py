"""Normalising, hashing and masking of text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(text: str | Column) -> Column:
    """Trimmed lower-case form of a code or name."""
    return F.lower(F.trim(F.col(text) if isinstance(text, str) else text))


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the joined columns.

    ``concat_ws`` skips NULLs, so (a, NULL, b) and (a, b, NULL) share a hash;
    use :func:`differs` to decide whether a row changed.
    """
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256)


def differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe "any column differs" between two joined aliases."""
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, tests)


def masked_email(email: str | Column) -> Column:
    """First character and domain stay readable."""
    column = F.col(email) if isinstance(email, str) else email
    return F.regexp_replace(column, "^(.)[^@]*@", "$1***@")
