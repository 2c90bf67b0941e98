"""Near-duplicates by 64-bit SimHash fingerprints, linked with a pigeonring filter.

A fingerprint is cut into five segments laid out as a ring.  If two fingerprints
differ in at most four bits, then from some segment on the differences summed over
1, 2, 3, 4, 5 consecutive segments stay within 0, 1, 2, 3, 4: the proportional share
of the budget, rounded down (the strong form of the pigeonhole principle on a ring).
The first two steps of the chain are a join: a segment equal, and the next
with at most one bit changed, so 26 bits decide where two fingerprints can meet.
The further steps are checked on the joined pair before the full distance.

Copies share a fingerprint, so the search runs on *distinct* fingerprints: a group of
copies of any size is one row in it.  Near copies are joined only where they share 26 bits.

Defined results: null text and texts without a word have fingerprint zero, which
links like any other; texts with fewer words than a shingle are one shingle;
``component_id`` is the smallest non-null id of the component (null if there is
none); rows are never merged, so repeated rows come out repeated; columns other
than doc_id and text are ignored by ``near_duplicates`` and kept by ``one_per_group``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.words import fresh, row_hash
from tidemark.session import stored

SEED = 42
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit, width
BUDGET = 4
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE = (np.arange(8) * 256)[None, :]


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Majority of the XXH64 bits of all word shingles of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - shingle + 1, 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True)
    hashed = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, n)
    places = (hashed.view(np.uint8).reshape(-1, 8) + _BYTE).ravel()
    ones = (np.bincount(places, minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, row_hash, fp for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in text), np.int64, len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_hash"), pa.array(found)], names=["doc_id", "row_hash", "fp"]
            )

    rows = documents.select("doc_id", row_hash(documents).alias("row_hash"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row_hash long, fp long")


def _segment(fp: Column, i: int) -> Column:
    first, width = SEGMENTS[i % len(SEGMENTS)]
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def _key(i: int, here: Column, after: Column) -> Column:
    return F.lit(i << 26).bitwiseOR(F.shiftleft(here, 13)).bitwiseOR(after)


def links(distinct: DataFrame) -> DataFrame:
    """Pairs a < b of distinct fingerprints (column fp) that differ in at most ``BUDGET`` bits."""
    fp = F.col("fp")
    stored_keys, asked_keys = [], []
    for i in range(len(SEGMENTS)):
        here, after = _segment(fp, i), _segment(fp, i + 1)
        stored_keys.append(_key(i, here, after))
        width = SEGMENTS[(i + 1) % len(SEGMENTS)][1]
        asked_keys += [_key(i, here, after)] + [_key(i, here, after.bitwiseXOR(F.lit(1 << b))) for b in range(width)]
    index = distinct.select(F.col("fp").alias("a"), F.explode(F.array(*stored_keys)).alias("key"))
    asked = distinct.select(F.col("fp").alias("b"), F.explode(F.array(*asked_keys)).alias("key"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    chain = F.bit_count(differ) <= BUDGET
    # steps 3 and 4 of the chain from the segment the key belongs to; the join holds 1 and 2
    start = F.shiftright("key", 26)
    masks = [sum(((1 << w) - 1) << f for f, w in (SEGMENTS[j % 5] for j in range(i, i + 3))) for i in range(5)]
    longer = [sum(((1 << w) - 1) << f for f, w in (SEGMENTS[j % 5] for j in range(i, i + 4))) for i in range(5)]

    def within(options: list[int], allowed: int) -> Column:
        signed = [m - (1 << 64) if m >> 63 else m for m in options]
        mask = F.element_at(F.array(*[F.lit(m) for m in signed]), (start + 1).cast("int"))
        return F.bit_count(differ.bitwiseAND(mask)) <= allowed

    viable = (F.col("a") < F.col("b")) & within(masks, 2) & within(longer, 3) & chain
    # the planner sizes an explode by its input, some seventy times too low: it would broadcast ``asked``
    return index.join(asked.hint("merge"), "key").filter(viable).select("a", "b").distinct()


def near_duplicates(documents: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, row_hash, fingerprint (16 hex digits), root (a fingerprint of its group), component_id of every document."""
    prints = stored(fingerprints(documents, shingle), "fingerprints")
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = components(links(groups.select("fp"))).withColumnRenamed("node", "fp")
    rooted = groups.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(rooted.join(lowest, "root").select("fp", "root", "component_id"), "fingerprint-components")
    return prints.join(named, "fp").select(
        "doc_id", "row_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "root", "component_id"
    )


def one_per_group(documents: DataFrame, shingle: int = 4) -> DataFrame:
    """The document with the smallest id of each group (of repeated rows, one), all columns kept.

    Rows without an id stay, as nothing tells which of them a group should keep.
    """
    own, kept_id, kept_hash = (fresh(documents, name) for name in ("row_hash", "kept_id", "kept_hash"))
    found = near_duplicates(documents, shingle)
    first = (
        found.filter("doc_id = component_id").groupBy("root").agg(
            F.min("doc_id").alias(kept_id), F.min("row_hash").alias(kept_hash)).drop("root")
    )
    rows = documents.withColumn(own, row_hash(documents))
    kept = rows.join(first, (F.col("doc_id") == F.col(kept_id)) & (F.col(own) == F.col(kept_hash)), "left_semi")
    kept = kept.dropDuplicates(["doc_id", own]).drop(own)
    return kept.unionByName(documents.filter("doc_id IS NULL"))
