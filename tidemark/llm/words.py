"""Words of Arrow text columns, vectorised.

Word splitting, lower-casing and counting run inside Arrow and numpy on pieces of
a few megabytes, so memory in a task does not depend on the batch Spark sends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 8 << 20


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``limit`` bytes (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes.astype(np.int64)) // limit
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            if end > start:
                yield batch.slice(start, end - start)


@dataclass
class Words:
    """Words of a piece in order: ``vocabulary[codes]``, with the row each stands in."""

    codes: np.ndarray
    rows: np.ndarray
    vocabulary: pa.Array
    n_rows: int

    @property
    def counts(self) -> np.ndarray:
        """Words per row."""
        return np.bincount(self.rows, minlength=self.n_rows)

    @property
    def offsets(self) -> np.ndarray:
        """Start of each row in ``codes``, and the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))


#: Bytes as they are, but A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def translated(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """Texts with every byte looked up in ``table`` (256 bytes); null becomes empty.

    The result has buffers of its own: string kernels misread slices of an array.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return texts
    first = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[first[0] : first[-1]] if data else np.empty(0, np.uint8)
    buffers = [None, pa.py_buffer((first - first[0]).tobytes()), pa.py_buffer(table[raw].tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(texts), buffers)


def split(texts: pa.Array, table: np.ndarray = LOWER) -> Words:
    """Words between ASCII white space, A-Z lower-cased; null is an empty text.

    Another ``table`` can turn further ASCII characters into spaces.
    """
    texts = translated(texts, table)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not real.all():
        flat, rows = flat.filter(pa.array(real)), rows[real]
    encoded = flat.dictionary_encode()
    return Words(
        encoded.indices.to_numpy(zero_copy_only=False), rows, encoded.dictionary, len(texts)
    )


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    values = words.to_numpy(zero_copy_only=False).astype(object)
    return pd.util.hash_array(values, categorize=False) if len(values) else np.empty(0, np.uint64)


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the sorted ``keys``; ``len(keys)`` where absent."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = len(keys) - 1
    return np.where(keys[at] == wanted, at, len(keys))


def row_sums(values: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n_rows)


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row: with its id, tells it from other rows that share the id.

    The hash passes over nulls, so a mark per column tells (a, null) from (null, a).
    """
    return F.xxhash64(*[part for c in df.columns for part in (_named(c).cast("string"), _named(c).isNull())])


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
