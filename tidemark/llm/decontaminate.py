"""Benchmark passages in documents: a prefix-filtered containment join.

The words of the benchmark are ordered by rarity, counted over all documents.  A
document that contains a window (ten consecutive item words) contains each of its
words, so the rarest one alone is a necessary prefix: documents are probed for these
*anchors* only, and an anchor at position p with offset o in its window fixes the
place p - o, which must lie inside the document (positional bound) and leave room
for the window (length bound).  Places that survive are joined with the windows on
their whole text, which verifies containment exactly.

Tasks get three Bloom filters (benchmark words, anchors with their offsets, windows) of
fixed size, whatever the benchmark holds: they only prune, and the join decides.

Defined results: null text has no words; items without words have no windows, items
shorter than a window are one window; a window of several items counts for each;
repeated rows come out repeated; a null item_id is not listed; ids are sorted and
joined as strings; columns other than doc_id / item_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import fresh, hashes, pieces, row_hash, split
from tidemark.session import stored

WINDOW = 10
FILTER_BITS = 23  # log2 of the bits of a Bloom filter: 1 MB each
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Lower-cases A-Z and turns every other ASCII character that is no letter or digit into a space.
SPLITTER = np.arange(256, dtype=np.uint8)
SPLITTER[[c for c in range(128) if not chr(c).isalnum()]] = 32
SPLITTER[ord("A") : ord("Z") + 1] += 32


class Bloom:
    """A fixed-size set of 64-bit hashes that may report a member too many, never one too few."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __contains__(self, hashed) -> bool:
        return bool(self.has(np.array([hashed], np.uint64))[0])

    def has(self, hashed: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashed), bool)
        for place in _places(hashed):
            found &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def _places(hashed: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return [(hashed >> np.uint64(s)) & mask for s in (0, 20, 40)]


def _bloom(df: DataFrame, column: str) -> Bloom:
    """Build the filter by a bit-wise aggregate: at most 2**17 rows reach the driver."""
    value = F.col(column)
    place = F.explode(F.array(*[
        F.shiftrightunsigned(value, s).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) for s in (0, 20, 40)
    ]))
    bits = df.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("b")
    ).toPandas()
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    words[bits["w"].to_numpy(np.int64)] = bits["b"].to_numpy(np.int64).view(np.uint64)
    return Bloom(words)


def _spot(word: np.ndarray, offset: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of an anchor word with its offset in a window of some length."""
    return word ^ ((offset.astype(np.uint64) * np.uint64(257) + length.astype(np.uint64)) * _STEP)


def _window_hash(word: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    found = np.zeros(len(starts), np.uint64)
    for i in range(length):
        found = found * _STEP + word[starts + i]
    return found ^ (found >> np.uint64(29))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, words (the window's words in order) for each window of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words = split(piece.column("text"), SPLITTER)
            starts, lengths = _starts(words.counts, words.offsets, size)
            rows = words.rows[starts] if len(starts) else np.empty(0, np.int64)
            at = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum()) \
                if len(starts) else np.empty(0, np.int64)
            flat = words.vocabulary.take(pa.array(words.codes[at])).cast(pa.string())
            ends = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [piece.column("item_id").take(pa.array(rows)), pa.ListArray.from_arrays(ends, flat)],
                names=["item_id", "words"],
            )

    rows = benchmark.select("item_id", "text")
    kind = rows.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"item_id {kind}, words array<string>")


def _starts(counts: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every window of every row."""
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.repeat(offsets[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    return starts, np.repeat(np.minimum(counts, size), n)


def _hashed(df: DataFrame, columns: list[str], fill) -> DataFrame:
    """Rows of 64-bit hashes of a frame with ``words``; ``fill(batch)`` gives the arrays."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in fill(batch)], names=columns)

    return df.mapInArrow(run, ", ".join(f"{c} long" for c in columns))


def _word_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    lists = batch.column("words")
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return hashes(lists.flatten()), lengths


def word_counts(documents: DataFrame, only: Bloom) -> DataFrame:
    """word, n over all documents, for the words that the filter lets through."""
    shipped = documents.sparkSession.sparkContext.broadcast(only)

    def run(batches):
        for piece in pieces(batches):
            words = split(piece.column("text"), SPLITTER)
            n = np.bincount(words.codes, minlength=len(words.vocabulary))
            keep = np.flatnonzero(shipped.value.has(hashes(words.vocabulary)))
            yield pa.RecordBatch.from_arrays(
                [words.vocabulary.take(pa.array(keep)).cast(pa.string()), pa.array(n[keep].astype(np.int64))],
                names=["word", "n"],
            )

    return documents.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def anchored(distinct: DataFrame, counts: DataFrame) -> DataFrame:
    """For each distinct window: the offset of its rarest word (ties: the first place)."""
    spread = distinct.select("window_id", "words", F.posexplode("words").alias("offset", "word"))
    ranked = spread.join(counts, "word", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("offset"))).alias("best"),
        F.first("words").alias("words"),
    )
    return ranked.select("words", F.col("best.offset").alias("offset"))


def _anchor_hash(batch: pa.RecordBatch) -> list[np.ndarray]:
    word, lengths = _word_hashes(batch)
    offset = batch.column("offset").to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    anchor = word[starts + offset]
    whole = np.zeros(len(lengths), np.uint64)
    for length in np.unique(lengths):
        mine = lengths == length
        whole[mine] = _window_hash(word, starts[mine], int(length))
    return [anchor, _spot(anchor, offset, lengths), whole]


def _search(documents: DataFrame, anchors: Bloom, spots: Bloom, wholes: Bloom, lengths: list[int]) -> DataFrame:
    """row_id, doc_id, n_words and the candidate places (start, length, window) per document."""
    shipped = documents.sparkSession.sparkContext.broadcast((anchors, spots, wholes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, spots, wholes = shipped.value
        row = TaskContext.get().partitionId() << 33
        for piece in pieces(batches):
            words = split(piece.column("text"), SPLITTER)
            hashed = hashes(words.vocabulary)
            at = np.flatnonzero(anchors.has(hashed)[words.codes])
            word, offsets = hashed[words.codes], words.offsets
            first, end = offsets[words.rows[at]], offsets[words.rows[at] + 1]
            found = []
            for length in lengths:
                for offset in range(length):
                    start = at - offset
                    ok = (start >= first) & (start + length <= end)
                    ok[ok] = spots.has(_spot(word[at[ok]], np.array([offset]), np.array([length])))
                    start = start[ok]
                    start = start[wholes.has(_window_hash(word, start, length))]
                    found.append(np.stack([start, np.full(len(start), length)], axis=1))
            places = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
            start, length = places[:, 0], places[:, 1]
            order = np.argsort(start, kind="stable")
            start, length = start[order], length[order]
            flat = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum()) \
                if len(start) else np.empty(0, np.int64)
            ends = pa.array(np.concatenate(([0], np.cumsum(length))).astype(np.int32))
            taken = words.vocabulary.take(pa.array(words.codes[flat])).cast(pa.string())
            text = pc.binary_join(pa.ListArray.from_arrays(ends, taken), " ")
            rows = words.rows[start] if len(start) else np.empty(0, np.int64)
            per_row = np.bincount(rows, minlength=piece.num_rows)
            hits = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(per_row))).astype(np.int32)),
                pa.StructArray.from_arrays(
                    [pa.array(start - offsets[rows]), pa.array(length), text], names=["start", "length", "window"]
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + piece.num_rows)), piece.column("doc_id"), piece.column("row_hash"),
                 pa.array(words.counts.astype(np.int64)), hits],
                names=["row_id", "doc_id", "row_hash", "n_words", "hits"],
            )
            row += piece.num_rows

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", row_hash(documents).alias("row_hash"), "text")
    return rows.mapInArrow(
        run,
        f"row_id long, doc_id {kind}, row_hash long, n_words long, "
        "hits array<struct<start: long, length: long, window: string>>",
    )


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, row_hash, n_words, n_hit, items (ids as sorted strings) of every document."""
    listed = stored(windows(benchmark, size), "item-windows")
    distinct = stored(
        listed.groupBy("words").agg(F.lit(1)).select("words", F.array_join("words", " ").alias("window"))
        .withColumn("window_id", F.monotonically_increasing_id()), "distinct-windows"
    )
    vocabulary = _bloom(_hashed(distinct.select("words"), ["h"], lambda b: [_word_hashes(b)[0]]), "h")
    anchors = stored(_hashed(
        anchored(distinct, word_counts(documents, vocabulary)), ["anchor", "spot", "whole"], _anchor_hash
    ), "anchors")
    lengths = sorted(r[0] for r in distinct.select(F.size("words")).distinct().collect())  # at most ``size`` of them
    filters = [_bloom(anchors, c) for c in ("anchor", "spot", "whole")]
    searched = stored(_search(documents, *filters, lengths), "searched")

    places = searched.select("row_id", F.explode("hits").alias("h")).select("row_id", "h.*")
    real = places.join(distinct.select("window", "window_id"), "window").select("row_id", "start", "length", "window_id")
    real = stored(real, "verified")
    spans = real.groupBy("row_id").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"))
    of = distinct.join(listed, "words").select("window_id", F.col("item_id").cast("string").alias("item"))
    items = (
        real.select("row_id", "window_id").distinct().join(of.filter("item IS NOT NULL"), "window_id")
        .select("row_id", "item").distinct()
        .groupBy("row_id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["start"] + x["length"] - F.greatest(x["start"], s["end"]))).alias("n"),
            F.greatest(s["end"], x["start"] + x["length"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    hit = spans.select("row_id", covered.alias("n_hit")).join(items, "row_id", "left")
    return searched.select("row_id", "doc_id", "row_hash", "n_words").join(hit, "row_id", "left").select(
        "doc_id", "row_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    return contamination(documents, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark window, all columns kept."""
    own, bad_id, bad_hash = (fresh(documents, name) for name in ("row_hash", "bad_id", "bad_hash"))
    bad = contamination(documents, benchmark).filter("n_hit > 0").select(
        F.col("doc_id").alias(bad_id), F.col("row_hash").alias(bad_hash)
    ).distinct()
    rows = documents.withColumn(own, row_hash(documents))
    same = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.col(own) == F.col(bad_hash))
    return rows.join(bad, same, "left_anti").drop(own)
