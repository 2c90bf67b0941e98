"""Toxicity by two class-conditional Kneser-Ney language models.

Each class (toxic, ordinary) has a model of three levels, interpolated with
absolute discounting::

    P(w | h)  <-  P(w)  <-  P(stem(w))

Pairs are counted by documents.  Below them all counts are continuation counts: a word
counts once for every distinct word that it follows in the class, a stem once for every
distinct pair that it ends.  The discounted mass of each level is spread by backoff counts
that both classes share, tilted by how the class leans on the level below.  Shared counts are pooled
and stop at ``RARE`` (as n1, n2, n3+ do in modified Kneser-Ney), so an expression that
neither class has seen often weighs nearly the same in both and hardly moves the
score, while a frequent one rests on its counts by class; ``stem``, the first
letters of a word, lets unseen inflections lean on seen ones.  Exact copies of a
training text count once.  A document's score compares the two log-likelihoods,
normalised by length, over the whole text, over its worst stretch of ``WINDOW``
words and over its strong expressions (ratio above ``STRONG``), through a logistic link fitted on labelled rows that were kept
out of the counts.

Fitting uses at most ``TRAIN_DOCS`` labelled rows per class (those with the smallest
hash of their id) and keeps at most ``ENTRIES`` expressions per table, pairs by how far
their classes differ and all else by its greater count, so the model that tasks receive
has a fixed bound.  Class shares are counted over all labels.

Defined results: null text is empty text; an empty text scores the share of toxic
rows; a null id counts as the empty id text; repeated labels of an id count as
toxic if one is; with no labels, or labels of one class only, the score is the
smoothed share of toxic rows for every text; extra columns of inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import hashes, lookup, pieces, row_sums, split
from tidemark.session import stored

TRAIN_DOCS = 8_000
ENTRIES = 1 << 17
WINDOW = 32
STRONG = 4.0
LIFT = 1000.0
DISCOUNT = 0.75
RARE = 3
STEM_LETTERS = 5
EDGES = ".,;:!?\"'()[]{}<>|*#$%&_-/\\"
FEATURES = ["mean", "worst", "strong"]
START = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return before * MIX + word


def _expressions(texts: pa.Array):
    """Per word of the texts: row, hash of the word before, of the word, of its stem."""
    words = split(texts)
    plain = pc.utf8_lower(pc.utf8_trim(words.vocabulary, characters=EDGES))
    word = hashes(plain)[words.codes]
    stem = hashes(pc.utf8_slice_codeunits(plain, 0, STEM_LETTERS))[words.codes]
    before = np.concatenate(([START], word[:-1])) if len(word) else word
    if len(word):
        before[words.offsets[:-1][words.counts > 0]] = START
    return words, before, word, stem


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        words, before, word, stem = _expressions(piece.column("text"))
        toxic = piece.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)[words.rows]
        # an expression counts once in a document, however often it is repeated there
        pair = pair_key(before, word)
        _, once = np.unique(pair ^ (words.rows.astype(np.uint64) * MIX), return_index=True)
        before, word, stem, toxic = before[once], word[once], stem[once], toxic[once]
        pair, first, inverse = np.unique(pair[once], return_index=True, return_inverse=True)
        total = np.bincount(inverse, minlength=len(pair))
        bad = np.bincount(inverse, weights=toxic, minlength=len(pair)).astype(np.int64)
        keys = (pair, before[first], word[first], stem[first])
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.view(np.int64)) for k in keys] + [pa.array(bad), pa.array(total - bad)],
            names=["pair", "before", "word", "stem", "t", "o"],
        )


@dataclass
class Table:
    """Counts of expressions by class: keys sorted, one more row of zeros for "absent"."""

    keys: np.ndarray
    values: np.ndarray

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        return self.values[lookup(self.keys, wanted)]


def _table(df: DataFrame, key: str, values: list[str], worth: Column) -> Table:
    """The ``ENTRIES`` expressions of greatest worth of an aggregate, on the driver."""
    rows = df.orderBy(worth.desc(), key).limit(ENTRIES).select(key, *values).toPandas()
    keys = rows[key].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    filled = np.vstack([rows[values].to_numpy(np.float32)[order], np.zeros((1, len(values)), np.float32)])
    return Table(keys[order], filled)


@dataclass
class Model:
    pairs: Table  # (word before, word): t, o
    words: Table  # word: continuation counts t, o
    left: Table  # word before: counts of its pairs t, o, distinct pairs t, o, capped counts of its pairs
    stems: Table  # stem: continuation counts t, o
    tokens: np.ndarray  # distinct pairs by class
    word_types: np.ndarray
    stem_types: np.ndarray
    rare: np.ndarray  # sums of capped counts: words, stems
    prior: float
    weights: np.ndarray  # logistic link: intercept and three slopes

    def ratios(self, before: np.ndarray, word: np.ndarray, stem: np.ndarray) -> np.ndarray:
        """log P_toxic - log P_ordinary of every word."""
        s, w = self.stems(stem), self.words(word)
        pair, left = self.pairs(pair_key(before, word)), self.left(before)

        def shared(counts, total):
            return np.clip(counts[:, 0] + counts[:, 1], 0.5, RARE) / total

        stem_share, word_share = shared(s, self.rare[1]), shared(w, self.rare[0])
        pair_share = shared(pair, np.maximum(left[:, 4], 1))
        logs = []
        for c in (0, 1):
            n = max(self.tokens[c], 1.0)
            p = np.maximum(s[:, c] - DISCOUNT, 0) / n + DISCOUNT * (self.stem_types[c] + 1) / n * stem_share
            lean = p / stem_share
            p = np.maximum(w[:, c] - DISCOUNT, 0) / n + DISCOUNT * (self.word_types[c] + 1) / n * word_share * lean
            lean = p / word_share
            seen = left[:, c] > 0
            h = np.where(seen, left[:, c], 1)
            backed = np.where(seen, DISCOUNT * left[:, 2 + c] / h, 1.0)
            logs.append(np.log(np.maximum(pair[:, c] - DISCOUNT, 0) / h + backed * pair_share * lean))
        return logs[0] - logs[1]

    def features(self, texts: pa.Array) -> np.ndarray:
        """Mean ratio of the text, of its worst stretch, and of what exceeds ``STRONG`` (as a logarithm)."""
        words, before, word, stem = _expressions(texts)
        ratio = self.ratios(before, word, stem).astype(np.float64)
        counts, offsets = words.counts, words.offsets
        mean = row_sums(ratio, words.rows, words.n_rows) / np.maximum(counts, 1)
        worst = mean.copy()
        if len(ratio):
            sums = np.concatenate(([0.0], np.cumsum(ratio)))
            ends = np.arange(WINDOW, len(ratio) + 1)
            inside = words.rows[ends - 1] == words.rows[ends - WINDOW] if len(ends) else np.empty(0, bool)
            stretch = (sums[ends] - sums[ends - WINDOW])[inside] / WINDOW
            np.maximum.at(worst, words.rows[ends - 1][inside], stretch)
        strong = row_sums(np.maximum(ratio - STRONG, 0), words.rows, words.n_rows) / np.maximum(counts, 1)
        found = np.stack([mean, worst, np.log1p(LIFT * strong)], axis=1)
        found[np.diff(offsets) == 0] = np.nan
        return found

    def scores(self, texts: pa.Array) -> np.ndarray:
        x = self.features(texts)
        z = self.weights[0] + np.nan_to_num(x) @ self.weights[1:]
        return np.where(np.isnan(x[:, 0]), self.prior, 1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    penalty = np.diag([0.0] + [ridge] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + penalty @ beta
        hessian = (design * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(beta)), gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic) of the training rows."""
    spark = documents.sparkSession
    marked = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") != 0, 1).otherwise(0)).alias("toxic"))
    )
    shares = dict(marked.groupBy("toxic").count().collect())
    n_toxic, n_ordinary = shares.get(1, 0), shares.get(0, 0)
    prior = (n_toxic + 0.5) / (n_toxic + n_ordinary + 1)
    order = F.xxhash64("doc_id")
    # as many of either class: discounts then take the same share of both
    size = min(TRAIN_DOCS, n_toxic, n_ordinary) or TRAIN_DOCS
    sample = None
    for value in (0, 1):
        part = marked.filter(F.col("toxic") == value).orderBy(order, "doc_id").limit(size)
        sample = part if sample is None else sample.unionByName(part)
    # at most 2 * TRAIN_DOCS ids: a broadcast of proven size
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    texts = texts.dropDuplicates(["text", "toxic"])
    texts = stored(texts.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4))), "toxicity-texts")
    counted = texts.filter("fold <> 0").select("text", "toxic").mapInArrow(
        _count, "pair long, before long, word long, stem long, t long, o long"
    )
    pairs = stored(
        counted.groupBy("pair", "before", "word", "stem").agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "toxicity-pairs"
    )
    both = [F.sum("t").alias("t"), F.sum("o").alias("o")]
    types = [F.count_if(F.col("t") > 0).alias("tt"), F.count_if(F.col("o") > 0).alias("oo")]
    pooled = F.col("t") + F.col("o")
    capped = F.sum(F.least(pooled, F.lit(RARE)))
    common = F.greatest("t", "o")
    continued = [F.count_if(F.col(c) > 0).alias(c) for c in ("t", "o")]
    words = pairs.groupBy("word").agg(*continued)
    stems = pairs.groupBy("stem").agg(*continued)
    left = pairs.groupBy("before").agg(*both, *types, capped.alias("capped"))
    totals = words.agg(F.sum("t"), F.sum("o"), *types, capped).first()
    stem_totals = stems.agg(*types, capped).first()
    numbers = [float(x or 0) for x in (*totals, *stem_totals)]
    model = Model(
        _table(pairs, "pair", ["t", "o"], F.abs(F.col("t") - F.col("o"))),
        _table(words, "word", ["t", "o"], common),
        _table(left, "before", ["t", "o", "tt", "oo", "capped"], common),
        _table(stems, "stem", ["t", "o"], common),
        np.array(numbers[:2]), np.array(numbers[2:4]), np.array(numbers[5:7]),
        np.maximum([numbers[4], numbers[7]], 1.0), prior,
        np.array([np.log(prior / (1 - prior)), 0.0, 0.0, 0.0]),
    )
    shipped = spark.sparkContext.broadcast(model)

    def measure(batches):
        for piece in pieces(batches):
            x = shipped.value.features(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("toxic"), *(pa.array(x[:, i]) for i in range(3))], names=["toxic", *FEATURES]
            )

    held = texts.filter("fold = 0").select("text", "toxic").mapInArrow(
        measure, "toxic int, " + ", ".join(f"{name} double" for name in FEATURES)
    ).toPandas()
    held = held[held["mean"].notna()]
    y = held["toxic"].to_numpy(np.float64)
    if 0 < y.sum() < len(y):
        share = y.mean()
        weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
        model.weights = _logistic(held[FEATURES].to_numpy(np.float64), y, weight)
    return model


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for piece in pieces(batches):
            s = shipped.value.scores(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = documents.select("doc_id", "text", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def ordinary(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that the model does not reject, all columns kept."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for piece in pieces(batches):
            keep = shipped.value.scores(piece.column("text")) < 0.5
            yield piece.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)


def training_rows(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents and labels whose id has a remainder other than 0."""
    taught = remainder(F.col("doc_id"), 5) != 0
    return documents.filter(taught), labels.filter(taught)
