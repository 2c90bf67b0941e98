"""Log-probabilities of texts under a log-bilinear neural language model.

Tokens are words and one end per text.  The commonest words have vectors of their own,
both as predicted words and as context; their number is the square root of the training
tokens, so it grows with the corpus.  All other words fall into classes by their ending.
The model is factored: words with vectors lie in bands of equal size by rank, and a token's
probability is that of its band or ending class, times that of the word inside it.

A context is the sum of one vector per place (the two tokens before), every band, ending
class and word has a target vector and a bias, and their products, normalised over all
bands and classes and over the words of a band, are the probabilities.  Inside an ending
class a word has its smoothed share (c + 1) / (N_class + V_class + 1), so probabilities
add up to 1 over the known words and one unknown word per ending class.

Training is noise-contrastive, over all training texts: the vectors learn to tell the tokens
that follow a context from tokens drawn from the unigram distribution.  The expectation over
the noise is taken exactly, in batched matrix products over the distinct contexts of a piece
of text, instead of by samples.  In each of
``ROUNDS`` rounds every Spark task goes over its texts from the same vectors and returns what
it changed; Spark adds that up by vector, weighted by the tokens that used the vector in each
task.  Only the vectors, of the order of the square root of the corpus, come to the driver.

Word counts are exact and distributed.  Tasks get the ``HOT`` commonest words (more, if more
have vectors); the tokens outside them are joined with the count table by word.

Defined results: null text is empty text, which has one token, the end; a null id
counts as the empty id text; without training texts every count is 0; repeated rows
come out repeated; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.toxicity import remainder
from tidemark.llm.words import pieces, row_sums, split
from tidemark.session import stored

END = ""  # no word is empty
ENDINGS = 24
HOT = 1 << 17
WIDTH = 24
NOISE = 10.0
ROUNDS = 2
RATES = (0.25, 0.1)
BATCH = 2048  # contexts


def ending_class(words: pa.Array) -> np.ndarray:
    """The ending class of each word, by its last two letters."""
    tails = pc.utf8_slice_codeunits(pc.utf8_rtrim(words, characters=".,;:!?"), -2, None).dictionary_encode()
    codes = np.array([zlib.crc32(t.encode()) % ENDINGS for t in tails.dictionary.to_pylist()], np.int64)
    return codes[tails.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.int64)


def count_words(documents: DataFrame) -> DataFrame:
    """word, class by ending, n over all texts; the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words = split(piece.column("text"))
            n = np.bincount(words.codes, minlength=len(words.vocabulary))
            vocabulary = pa.concat_arrays([words.vocabulary, pa.array([END], words.vocabulary.type)])
            yield pa.RecordBatch.from_arrays(
                [vocabulary.cast(pa.string()), pa.array(ending_class(vocabulary)),
                 pa.array(np.append(n, piece.num_rows).astype(np.int64))],
                names=["word", "ending", "n"],
            )

    parts = documents.select("text").mapInArrow(run, "word string, ending long, n long")
    return parts.groupBy("word", "ending").agg(F.sum("n").alias("n")).filter("n > 0")


@dataclass
class Vocabulary:
    """What tasks know of the counts: the commonest words, and totals of the ending classes.

    Tokens are numbered as the model sees them: words with vectors by rank, then ending classes.
    """

    words: pa.Array  # the end first, then by falling count
    counts: np.ndarray
    endings: np.ndarray
    size: int  # words with vectors: the first ones
    total: int
    distinct: int
    tail_totals: np.ndarray  # of the words without vectors, by ending class
    tail_distinct: np.ndarray

    @property
    def band(self) -> int:
        """Words in a band."""
        return max(1, math.isqrt(self.size))

    @property
    def bands(self) -> int:
        return -(-self.size // self.band)

    def places(self, words: pa.Array, first: int | None = None) -> np.ndarray:
        """Index of each word among the known ones (the ``first`` of them), -1 where it is not."""
        found = pc.index_in(words.cast(pa.string()), value_set=self.words.slice(0, first))
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False)

    def outer(self, token: np.ndarray) -> np.ndarray:
        """Band of words with vectors, after the bands the ending classes."""
        return np.where(token < self.size, token // self.band, token - self.size + self.bands)

    def noise(self) -> tuple[np.ndarray, np.ndarray]:
        """Unigram shares of bands and classes, and of words inside their bands."""
        counts = self.counts[: self.size] + 1.0
        starts = np.arange(0, self.size, self.band)
        totals = np.add.reduceat(counts, starts) if self.size else np.empty(0)
        whole = np.concatenate((totals, self.tail_totals + self.tail_distinct + 1.0))
        inside = counts / np.repeat(totals, self.band)[: self.size]
        return (whole / whole.sum()).astype(np.float32), inside.astype(np.float32)


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total = int(total or 0)
    size = math.isqrt(total)
    # the end first, then by count: it always has a vector
    hot = counts.orderBy(F.col("word") != END, F.desc("n"), "word").limit(max(HOT, size)).toPandas()
    n = hot["n"].to_numpy(np.int64)
    endings = hot["ending"].to_numpy(np.int64)
    size = min(size, len(n))
    totals, kinds = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for row in counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        totals[row["ending"]], kinds[row["ending"]] = row["n"], row["v"]  # one row per ending class
    np.subtract.at(totals, endings[:size], n[:size])
    np.subtract.at(kinds, endings[:size], 1)
    return Vocabulary(pa.array(hot["word"].tolist(), pa.string()), n, endings, size, total, int(distinct), totals, kinds)


@dataclass
class Tokens:
    """Words and ends of a piece in order."""

    row: np.ndarray
    code: np.ndarray  # into the piece's words, -1 for the end
    place: np.ndarray  # among the known words, -1 where absent
    token: np.ndarray  # as the model numbers it
    two: np.ndarray  # two places before, one place before
    one: np.ndarray


def _numbered(
    words, known: Vocabulary, place: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """token, two, one of a piece, and which tokens are words; ``place``: of its vocabulary, if looked up."""
    start = known.size + ENDINGS
    if place is None:
        place = known.places(words.vocabulary, known.size)
    numbers = np.where((place >= 0) & (place < known.size), place, known.size + ending_class(words.vocabulary)).astype(np.int32)
    counts = words.counts
    ends = np.cumsum(counts + 1) - 1
    inside = np.ones(len(words.codes) + words.n_rows, bool)
    inside[ends] = False
    end_number = 0 if _end_place(known) == 0 and known.size else known.size + int(ending_class(pa.array([END]))[0])
    token = np.full(len(inside), end_number, np.int32)
    token[inside] = numbers[words.codes]
    one = np.concatenate((np.array([start], np.int32), token[:-1]))[: len(token)]
    two = np.concatenate((np.array([start, start], np.int32), token[:-2]))[: len(token)]
    first = ends - counts
    one[first] = start
    two[first] = start
    two[np.minimum(first + 1, len(token) - 1)] = start  # second token of its text, or the first of the next
    return token, two, one, inside


def _end_place(known: Vocabulary) -> int:
    return 0 if len(known.words) and known.words[0].as_py() == END else -1


def _tokens(words, known: Vocabulary) -> Tokens:
    place = known.places(words.vocabulary)
    token, two, one, inside = _numbered(words, known, place)
    code = np.full(len(inside), -1, np.int32)
    code[inside] = words.codes
    at = np.full(len(inside), _end_place(known), np.int32)
    at[inside] = place.astype(np.int32)[words.codes]
    return Tokens(np.repeat(np.arange(words.n_rows, dtype=np.int32), words.counts + 1), code, at, token, two, one)


@dataclass
class Grouped:
    """Distinct contexts of a piece, and under each the distinct tokens that follow it."""

    two: np.ndarray
    one: np.ndarray
    edges: np.ndarray  # of each context's tokens
    token: np.ndarray
    n: np.ndarray
    of: np.ndarray  # for each token of the piece, its place among the distinct ones; empty if mixed

    def batches(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, slice]]:
        """Contexts (two, one); tokens after them: row of the context, token, and their slice."""
        for at in range(0, len(self.two), BATCH):
            part = slice(at, min(at + BATCH, len(self.two)))
            inner = slice(self.edges[part.start], self.edges[part.stop])
            row = np.repeat(np.arange(part.stop - part.start), np.diff(self.edges[part.start : part.stop + 1]))
            yield self.two[part], self.one[part], row, self.token[inner], inner


def grouped(token: np.ndarray, two: np.ndarray, one: np.ndarray, known: Vocabulary, mixed: bool = False) -> Grouped:
    """Tokens grouped by context; contexts in a random order that is the same in every run, if ``mixed``."""
    numbers = known.size + ENDINGS + 1
    key = two.astype(np.int64)
    for part in (one, token):
        key *= numbers
        key += part
    if mixed:  # which token is which is not asked when learning, and a plain sort holds less
        key.sort()
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    new = _changes(key)
    first = np.flatnonzero(new)
    n = np.diff(first, append=len(key)).astype(np.float32)
    of = np.empty(0, np.int64)
    if not mixed:
        of = np.empty(len(key), np.int64)
        of[order] = np.cumsum(new) - 1
    del new
    pair = key[first]
    del key, first
    context = pair // numbers
    pair -= context * numbers
    starts = np.flatnonzero(_changes(context))
    context, sizes = context[starts], np.diff(starts, append=len(pair))
    if mixed:
        shuffled = np.empty_like(starts)
        shuffled[np.random.default_rng(len(token)).permutation(len(context))] = np.arange(len(context))
        context, starts, sizes = context[shuffled], starts[shuffled], sizes[shuffled]
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(pair))
        pair, n = pair[at], n[at]
    edges = np.concatenate(([0], np.cumsum(sizes)))
    return Grouped(context // numbers, context % numbers, edges, pair, n, of)


def _changes(values: np.ndarray) -> np.ndarray:
    """Which values of a sorted array differ from the one before."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


@dataclass
class Model:
    """Vectors in one matrix: contexts two places before, one place before, bands and classes, words.

    The last column holds the biases of targets; of contexts it is 1 and 0, so a product adds the bias.
    """

    values: np.ndarray
    known: Vocabulary

    @property
    def edges(self) -> tuple[int, int, int]:
        """First rows of the contexts one place before, of bands and classes, and of words."""
        places = self.known.size + ENDINGS + 1
        return places, 2 * places, 2 * places + self.known.bands + ENDINGS

    def contexts(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        return self.values[two] + self.values[self.edges[0] + one]

    def targets(self) -> tuple[np.ndarray, np.ndarray]:
        _, classes, words = self.edges
        return self.values[classes:words], self.values[words:]

    def log_probabilities(self, token: np.ndarray, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token's band or class, times that of the word in its band.

        Every context is normalised once, and once more for each band that follows it.
        """
        group = grouped(token, two, one, self.known)
        found = np.empty(len(group.token))
        classes, words = self.targets()
        for two_, one_, row, follows, inner in group.batches():
            q, kind = self.contexts(two_, one_), self.known.outer(follows)
            logs = _normalised(q @ classes.T, row, kind).astype(np.float64)
            pairs = Pairs(row, kind, self.known)
            near = q[pairs.row]
            scores = np.full((len(near), self.known.band), -np.inf, np.float32)  # the last band lacks words
            for of, which in pairs.bands:
                scores[which, : of.stop - of.start] = near[which] @ words[of].T
            logs[pairs.at] += _normalised(scores, pairs.pair, follows[pairs.at] % self.known.band)
            found[inner] = logs
        return found[group.of] / np.log(10)


def _normalised(scores: np.ndarray, row: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log-probabilities of the wanted outputs of their rows, among all outputs of each; overwrites the scores."""
    scores -= scores.max(axis=1, keepdims=True)
    found = scores[row, wanted]
    found -= np.log(np.exp(scores, out=scores).sum(axis=1))[row]
    return found


def _order(values: np.ndarray, most: int) -> np.ndarray:
    """Places in rising order of ``values`` below ``most``, equal ones as they stood; short numbers sort faster."""
    return np.argsort(values.astype(np.uint16 if most <= 1 << 16 else np.int32), kind="stable")


class Pairs:
    """Pairs of a band and a context that it follows, by band, so that all bands of a batch share the work on scores.

    Tokens come by context, so those of a band do too.
    """

    def __init__(self, row: np.ndarray, kind: np.ndarray, known: Vocabulary):
        order = _order(kind, known.bands + ENDINGS)
        self.at = order[: np.count_nonzero(kind < known.bands)]  # tokens that are words with vectors
        row, kind = row[self.at], kind[self.at]
        new = _changes(row) | _changes(kind)
        self.pair = np.cumsum(new) - 1  # of each of these tokens
        self.row, self.of = row[new], kind[new]  # context and band of each pair
        sizes = np.bincount(self.of, minlength=known.bands)
        ends = np.cumsum(sizes)
        used = np.flatnonzero(sizes)
        firsts, band, size = (used * known.band).tolist(), known.band, known.size
        starts, ends = (ends - sizes)[used].tolist(), ends[used].tolist()
        #: words of each band that occurs, and its pairs
        self.bands = [(slice(f, min(f + band, size)), slice(*x)) for f, *x in zip(firsts, starts, ends, strict=True)]


def starting(known: Vocabulary, seed: int = 8) -> Model:
    """Small random vectors, and biases that give the unigram distribution."""
    outer, inner = known.noise()
    model = Model(np.empty((0, WIDTH + 1), np.float32), known)
    one, classes, words = model.edges
    values = np.random.default_rng(seed).normal(0, 0.1, (words + known.size, WIDTH + 1)).astype(np.float32)
    values[:one, -1], values[one:classes, -1] = 1, 0
    values[classes:words, -1], values[words:, -1] = np.log(outer), np.log(inner)
    model.values = values
    return model


class Learner:
    """Noise-contrastive steps over batches, with step sizes by the gradients seen (Adagrad)."""

    def __init__(self, model: Model, rate: float):
        self.model = Model(model.values.copy(), model.known)
        self.rate = np.float32(rate)
        self.seen = np.ones_like(model.values)
        self.uses = np.zeros(len(model.values), np.int64)
        outer, inner = model.known.noise()
        self.outer, self.inner = np.float32(NOISE) * outer, np.zeros((model.known.bands, model.known.band), np.float32)
        self.inner.ravel()[: model.known.size] = np.float32(NOISE) * inner  # the last band may lack words

    def _move(self, rows, gradient: np.ndarray) -> None:
        seen = gradient * gradient
        seen += self.seen[rows]
        self.seen[rows] = seen
        np.sqrt(seen, out=seen)
        np.divide(self.rate * gradient, seen, out=seen)
        self.model.values[rows] += seen

    def _contexts(self, place: np.ndarray, gradient: np.ndarray, mass: np.ndarray) -> None:
        order = _order(place, len(self.uses))
        ordered = place[order]
        first = np.flatnonzero(np.diff(ordered, prepend=-1))
        rows = ordered[first]
        self.uses[rows] += np.add.reduceat(mass[order], first).astype(np.int64)
        self._move(rows, np.add.reduceat(gradient[order], first))

    def step(self, two: np.ndarray, one: np.ndarray, row: np.ndarray, token: np.ndarray, n: np.ndarray) -> None:
        """Learn from distinct contexts and the tokens after them, seen ``n`` times each."""
        known = self.model.known
        edge_one, edge_classes, edge_words = self.model.edges
        q, kind = self.model.contexts(two, one), known.outer(token)
        classes, words = self.model.targets()
        mass = np.bincount(row, weights=n, minlength=len(q)).astype(np.float32)
        slope = _slopes(q @ _against(classes, self.outer).T, mass, self.outer, row, kind, n)
        back = slope @ classes
        moves = [(slice(edge_classes, edge_words), slope.T @ q)]
        self.uses[edge_classes:edge_words] += int(mass.sum())
        pairs = Pairs(row, kind, known)
        near, share = q[pairs.row], np.bincount(pairs.pair, weights=n[pairs.at]).astype(np.float32)
        against = _against(words, self.inner.ravel()[: known.size])
        slope = np.zeros((len(near), known.band), np.float32)
        for of, which in pairs.bands:
            np.matmul(near[which], against[of].T, out=slope[which, : of.stop - of.start])
        slope = _slopes(slope, share, self.inner[pairs.of], pairs.pair, token[pairs.at] % known.band, n[pairs.at])
        gradient = np.zeros_like(words)
        for of, which in pairs.bands:
            inside = slope[which, : of.stop - of.start]
            back[pairs.row[which]] += inside @ words[of]
            np.matmul(inside.T, near[which], out=gradient[of])
        moves.append((slice(edge_words, None), gradient))  # words of other bands stay
        uses = np.bincount(pairs.of, weights=share, minlength=known.bands).astype(np.int64)
        self.uses[edge_words:] += np.repeat(uses, known.band)[: known.size]
        for rows, gradient in moves:
            self._move(rows, gradient)
        back[:, -1] = 0
        self._contexts(two, back, mass)
        self._contexts(one + edge_one, back, mass)


def _against(targets: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """Vectors whose products are the scores of noise against data."""
    against = -targets
    against[:, -1] += np.log(noise)
    return against


def _slopes(
    scores: np.ndarray, mass: np.ndarray, noise: np.ndarray, row: np.ndarray, wanted: np.ndarray, n: np.ndarray
) -> np.ndarray:
    """Slope of the objective by score, for rows with a mass of tokens each, ``n`` of them the wanted output.

    Noise lowers every output by noise * data, where data is the probability that the output is data, not
    noise; every token seen raises its own by 1 - data.  Overwrites ``scores``, those of noise against data;
    rows may each have noise of their own.
    """
    slope = np.exp(scores, out=scores)
    slope += 1
    np.divide(-noise, slope, out=slope)
    raised = n * (1 + slope[row, wanted] / (noise[wanted] if noise.ndim == 1 else noise[row, wanted]))
    slope *= mass[:, None]
    np.add.at(slope.ravel(), row * slope.shape[1] + wanted, raised.astype(np.float32))
    return slope


NAMES = [f"v{i}" for i in range(WIDTH + 1)]


def train_round(documents: DataFrame, model: Model, rate: float) -> Model:
    """Every task learns from its texts; a vector moves by the mean of the moves, weighted by its uses."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        learner = None
        for piece in pieces(batches):
            if not piece.num_rows:
                continue
            learner = learner or Learner(model, rate)
            token, two, one, _ = _numbered(split(piece.column("text")), model.known)
            group = grouped(token, two, one, model.known, mixed=True)
            del token, two, one  # the groups hold all that is learned from
            for two, one, row, token, inner in group.batches():
                learner.step(two, one, row, token, group.n[inner])
            del group
        if learner is not None:
            rows = np.flatnonzero(learner.uses)
            n = learner.uses[rows]
            moved = (learner.model.values[rows] - model.values[rows]) * n[:, None]
            for at in range(0, len(rows), BATCH):
                part = slice(at, at + BATCH)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[part]), pa.array(n[part]), *(pa.array(c) for c in moved[part].T.astype(np.float64))],
                    names=["row", "n", *NAMES],
                )

    kinds = "row long, n long, " + ", ".join(f"{c} double" for c in NAMES)
    moves = documents.select("text").mapInArrow(run, kinds).groupBy("row").agg(
        *[(F.sum(c) / F.sum("n")).cast("float").alias(c) for c in NAMES]
    ).toPandas()  # one row per vector
    values = model.values.copy()
    values[moves["row"].to_numpy()] += moves[NAMES].to_numpy(np.float32)
    shipped.unpersist()
    return Model(values, model.known)


def train(documents: DataFrame, known: Vocabulary) -> Model:
    model = starting(known)
    for rate in RATES[:ROUNDS]:
        model = train_round(documents, model, rate)
    return model


def _partial(documents: DataFrame, model: Model) -> DataFrame:
    """Per document what the hot words give, and its other words with their numbers."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        known = model.known
        hot_log = np.append(np.log10(known.counts + 1.0), 0.0)  # absent words add theirs after the join
        share = np.log10(known.tail_totals + known.tail_distinct + 1)
        row_id = TaskContext.get().partitionId() << 33
        for piece in pieces(batches):
            if not piece.num_rows:
                continue
            words = split(piece.column("text"))
            t = _tokens(words, known)
            hot = t.place >= 0
            count_log = hot_log[t.place]
            tail = t.token >= known.size
            model_log = model.log_probabilities(t.token, t.two, t.one)
            model_log[tail] += count_log[tail] - share[t.token[tail] - known.size]
            rest = ~hot & (t.code >= 0)
            kinds = max(len(words.vocabulary), 1)
            pair, n = np.unique(t.row[rest].astype(np.int64) * kinds + t.code[rest], return_counts=True)
            rare = pa.StructArray.from_arrays(
                [words.vocabulary.take(pa.array(pair % kinds)).cast(pa.string()), pa.array(n)], names=["word", "n"]
            )
            splits = np.concatenate(([0], np.cumsum(np.bincount(pair // kinds, minlength=words.n_rows)))).astype(np.int32)
            sums = [row_sums(x, t.row, words.n_rows) for x in (count_log, model_log)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row_id, row_id + piece.num_rows)), piece.column("doc_id"), piece.column("held_out"),
                 pa.array(words.counts + 1), pa.array(row_sums(hot, t.row, words.n_rows).astype(np.int64)),
                 pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(pa.array(splits), rare)],
                names=["row_id", "doc_id", "held_out", "n_tokens", "n_hot", "count_log", "model_log", "rare"],
            )
            row_id += piece.num_rows

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", "held_out").mapInArrow(
        run,
        f"row_id long, doc_id {kind}, held_out boolean, n_tokens long, n_hot long, count_log double, "
        "model_log double, rare array<struct<word: string, n: long>>",
    )


def score(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    rows = documents.select("doc_id", "text", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"))
    training = rows.filter("NOT held_out")
    counts = stored(count_words(training), "word-counts")
    known = vocabulary(counts)
    partial = stored(_partial(rows, train(training, known)), "scored")
    rare = partial.select("row_id", F.explode("rare").alias("r")).select("row_id", "r.word", "r.n")
    seen = counts.select("word", F.col("n").alias("c"))
    found = rare.join(seen, "word").groupBy("row_id").agg(
        F.sum("n").alias("n_rare"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_log")
    )
    total, distinct = known.total, known.distinct
    more = F.coalesce("rare_log", F.lit(0.0))
    whole = float(np.log10(total + distinct + 1))
    return partial.drop("rare").join(found, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_hot") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("count_log") + more - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("model_log") + more).alias("score"),
    )
