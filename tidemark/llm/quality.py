"""Text quality by a generalised additive model with pairwise interactions.

A text is measured by ``FEATURES``: length, word and line shape, repetition, character
classes.  Each feature is cut at quantiles of the training sample into at most ``BINS``
bins, bin 0 being "not defined" (an empty text has no word length).  Boosting goes
round the features in cycles: a tree of at most ``LEAVES`` leaves over one feature's bins
is fitted to the log-loss gradients, and its leaf values, shrunk, are added to that
feature's lookup table.  When the tables no longer help held-back rows, the pairs of
features whose coarse grid still explains most of what is left get tables of their own,
by the same cycles of shallow trees over two features.  A score is a logistic link over
the sum of the looked-up values, so scoring is a search for bins and vector additions.

Fitting takes at most about ``TRAIN_DOCS`` labelled rows per class, those whose id hashes
below a threshold; class shares are counted over all labels and weigh the sample back.
The model has a fixed size, whatever the size of the corpus.

Defined results: null text is empty text; an empty text has its own score, learnt from
the empty training texts, if any; null labels and null ids of labels teach nothing;
repeated labels of an id count as good if one is; of the texts of a repeated id the least
one teaches; with no labels, or labels of one class only, every score is the smoothed
share of good rows; extra columns of inputs are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.toxicity import remainder
from tidemark.llm.words import pieces, split, translated

TRAIN_DOCS = 20_000
BINS = 48
GRID = 12
LEAVES = 4
PAIRS = 10
CYCLES = 60
PATIENCE = 4
RATE = 0.15
SHRINK = 4.0
FEATURES = [
    "words", "word_length", "length_spread", "longest", "long_words", "distinct", "commonest", "stutter", "pairs_again",
    "lines", "line_words", "lines_again", "ended_lines", "short_lines", "letters", "digits", "marks", "symbols",
    "capitals", "foreign", "spaces", "ends", "wordless", "entropy",
]
_KINDS = {
    "letters": b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)),
    "digits": b"0123456789",
    "marks": b".,;:!?'\"()-",
    "symbols": b"#$%&*+/<=>@[\\]^_`{|}~",
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "foreign": bytes(range(192, 256)),
    "spaces": b" \t\n\v\f\r",
    "ends": b".!?",
}
_SAME = np.arange(256, dtype=np.uint8)
_MEMBER = {name: np.isin(_SAME, np.frombuffer(chars, np.uint8)) for name, chars in _KINDS.items()}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _per_row(values: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n_rows)


def _again(codes: np.ndarray, rows: np.ndarray, n_rows: int, weights: np.ndarray | None = None):
    """Per row: number of distinct codes, sum of the weights of repeats, greatest count, entropy of the codes."""
    key = codes.astype(np.uint64) * _MIX + rows.astype(np.uint64)
    _, first, inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    owner = rows[first]
    distinct = np.bincount(owner, minlength=n_rows)
    repeated = np.ones(len(key), bool)
    repeated[first] = False
    top = np.zeros(n_rows)
    np.maximum.at(top, owner, counts)
    n = np.bincount(rows, minlength=n_rows)
    share = counts / np.maximum(n[owner], 1)
    entropy = _per_row(-share * np.log2(share), owner, n_rows)
    return distinct, _per_row(repeated * (1.0 if weights is None else weights), rows, n_rows), top, entropy


def measures(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; what an empty text or line list cannot have is NaN."""
    n_rows = len(texts)
    plain = translated(texts, _SAME)
    if not n_rows:
        return np.empty((0, len(FEATURES)))
    found: dict[str, np.ndarray] = {}
    words = split(plain, _SAME)
    n = words.counts.astype(float)
    some = np.where(n > 0, n, np.nan)
    length = pc.utf8_length(words.vocabulary).to_numpy(zero_copy_only=False).astype(float)[words.codes]
    total = _per_row(length, words.rows, n_rows)
    longest = np.zeros(n_rows)
    np.maximum.at(longest, words.rows, length)
    found["words"] = np.log1p(n)
    found["word_length"] = total / some
    squares = _per_row(length * length, words.rows, n_rows) / some
    found["length_spread"] = np.sqrt(np.maximum(squares - found["word_length"] ** 2, 0))
    found["longest"] = np.log1p(longest)
    found["long_words"] = _per_row(length > 20, words.rows, n_rows) / some
    distinct, _, top, entropy = _again(words.codes, words.rows, n_rows)
    found["distinct"] = distinct / some**0.8  # types grow more slowly than words
    found["commonest"] = top / some
    found["entropy"] = entropy / np.log2(some + 1)
    inside = words.rows[1:] == words.rows[:-1]
    same = (words.codes[1:] == words.codes[:-1]) & inside
    found["stutter"] = _per_row(same, words.rows[1:], n_rows) / some
    both = words.codes[1:].astype(np.uint64) * np.uint64(len(words.vocabulary) + 1) + words.codes[:-1].astype(np.uint64)
    _, repeats, _, _ = _again(both[inside], words.rows[1:][inside], n_rows)
    found["pairs_again"] = repeats / some
    lettered = pc.match_substring_regex(words.vocabulary, r"\pL").to_numpy(zero_copy_only=False)
    found["wordless"] = _per_row(~lettered[words.codes], words.rows, n_rows) / some

    split_lines = pc.split_pattern(plain, "\n")
    lines = pc.utf8_trim_whitespace(split_lines.flatten())
    row = np.repeat(np.arange(n_rows), pc.list_value_length(split_lines).to_numpy(zero_copy_only=False).astype(np.int64))
    filled = pc.not_equal(lines, "").to_numpy(zero_copy_only=False)
    lines, row = lines.filter(pa.array(filled)), row[filled]
    n_lines = np.bincount(row, minlength=n_rows)
    some_lines = np.where(n_lines > 0, n_lines, np.nan)
    size = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(float)
    ended = pc.match_substring_regex(lines, r"[.!?][\"')\]]*$").to_numpy(zero_copy_only=False)
    coded = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    _, doubled, _, _ = _again(coded, row, n_rows, size)
    found["lines"] = some_lines / some
    found["line_words"] = np.log1p(some / some_lines)
    found["lines_again"] = doubled / np.where(total > 0, total, np.nan)
    found["ended_lines"] = _per_row(ended, row, n_rows) / some_lines
    found["short_lines"] = _per_row(size < 30, row, n_rows) / some_lines

    offsets = np.frombuffer(plain.buffers()[1], np.int64)[: n_rows + 1]
    raw = np.frombuffer(plain.buffers()[2], np.uint8)[: offsets[-1]] if offsets[-1] else np.empty(0, np.uint8)
    n_bytes = np.diff(offsets)
    some_bytes = np.where(n_bytes > 0, n_bytes, np.nan)
    for name, member in _MEMBER.items():
        upto = np.concatenate(([0], np.cumsum(member[raw], dtype=np.int64)))
        found[name] = np.diff(upto[offsets]) / (some if name == "ends" else some_bytes)
    return np.column_stack([found[name] for name in FEATURES])


@dataclass
class Model:
    """Lookup tables: one per feature and one per chosen pair, over quantile bins."""

    cuts: list[np.ndarray]
    intercept: float
    mains: np.ndarray  # feature x bin
    coarse: np.ndarray  # feature x bin: its place in the grid of a pair
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: np.ndarray = field(default_factory=lambda: np.zeros((0, GRID + 1, GRID + 1)))

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bin of every value; 0 where it is not defined."""
        bins = np.zeros(x.shape, np.int64)
        for j, cuts in enumerate(self.cuts):
            bins[:, j] = np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(cuts, x[:, j], side="right"))
        return bins

    def margins(self, bins: np.ndarray) -> np.ndarray:
        z = np.full(len(bins), self.intercept)
        for j in range(bins.shape[1]):
            z += self.mains[j][bins[:, j]]
        for (a, b), grid in zip(self.pairs, self.grids, strict=True):
            z += grid[self.coarse[a][bins[:, a]], self.coarse[b][bins[:, b]]]
        return z

    def scores(self, texts: pa.Array) -> np.ndarray:
        return _sigmoid(self.margins(self.binned(measures(texts))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _loss(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    return float(np.sum(w * (np.logaddexp(0, z) - y * z)) / w.sum())


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + SHRINK) + right_g**2 / (right_h + SHRINK) - g.sum() ** 2 / (h.sum() + SHRINK)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _line_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of every bin: the run is cut where that gains most, into ``LEAVES`` parts; bin 0 stands alone."""
    parts = [(1, len(g))]
    for _ in range(LEAVES - 1):
        found = [(*_best_cut(g[a:b], h[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(found)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    value = np.zeros(len(g))
    for a, b in [(0, 1), *parts]:
        value[a:b] = g[a:b].sum() / (h[a:b].sum() + SHRINK)
    return value


def _grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree over two features: one cut of either, then one cut of the other in each half."""
    best_gain, best = 0.0, np.zeros_like(g)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        below_g, below_h = np.cumsum(a, axis=0), np.cumsum(b, axis=0)
        for at in range(1, len(a)):
            gain, value = 0.0, np.zeros_like(a)
            halves = (
                (slice(0, at), below_g[at - 1], below_h[at - 1]),
                (slice(at, None), below_g[-1] - below_g[at - 1], below_h[-1] - below_h[at - 1]),
            )
            for rows, gs, hs in halves:
                more, cut = _best_cut(gs, hs)
                gain += more + gs.sum() ** 2 / (hs.sum() + SHRINK)
                for columns in (slice(0, cut), slice(cut, None)):
                    value[rows, columns] = gs[columns].sum() / (hs[columns].sum() + SHRINK)
            if gain > best_gain:
                best_gain, best = gain, value.T if turned else value
    return best_gain - g.sum() ** 2 / (h.sum() + SHRINK), best


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float) -> Model:
    """Boost mains, then pairs, on rows of features; every fifth row is held back to say when to stop."""
    cuts = []
    for j in range(x.shape[1]):
        known = x[~np.isnan(x[:, j]), j]
        cuts.append(np.unique(np.quantile(known, np.arange(1, BINS) / BINS)) if len(known) else np.empty(0))
    width = BINS + 1
    coarse = np.zeros((x.shape[1], width), np.int64)
    for j, c in enumerate(cuts):
        coarse[j, 1:] = 1 + np.minimum(np.arange(width - 1) * GRID // (len(c) + 1), GRID - 1)
    model = Model(cuts, float(np.log(prior / (1 - prior))), np.zeros((x.shape[1], width)), coarse)
    if not 0 < y.sum() < len(y):
        return model
    bins = model.binned(x)
    held = np.arange(len(y)) % 5 == 4
    if not (0 < y[~held].sum() < (~held).sum() and held.any()):
        held[:] = False
    fit, test = np.flatnonzero(~held), np.flatnonzero(held) if held.any() else np.arange(len(y))
    z, zt = np.full(len(fit), model.intercept), np.full(len(test), model.intercept)
    yf, wf = y[fit], weight[fit]

    def slopes():
        p = _sigmoid(z)
        return wf * (yf - p), wf * np.maximum(p * (1 - p), 1e-6)

    def cycles(tables, cells, tree, size):
        """Go round the tables until held-back rows stop gaining; keep the best state."""
        nonlocal z, zt
        best, kept, idle = _loss(zt, y[test], weight[test]), tables.copy(), 0
        for _ in range(CYCLES):
            for j, cell in enumerate(cells):
                g, h = slopes()
                step = RATE * tree(np.bincount(cell[fit], g, size), np.bincount(cell[fit], h, size)).ravel()
                tables[j] += step.reshape(tables[j].shape)
                z, zt = z + step[cell[fit]], zt + step[cell[test]]
            now = _loss(zt, y[test], weight[test])
            if now < best - 1e-5:
                best, kept, idle = now, tables.copy(), 0
            else:
                idle += 1
            if idle >= PATIENCE:
                break
        tables[:] = kept
        margins = model.margins(bins)
        z, zt = margins[fit], margins[test]

    cycles(model.mains, [bins[:, j] for j in range(x.shape[1])], _line_tree, width)
    side = GRID + 1
    g, h = slopes()
    gains = []
    for a in range(x.shape[1]):
        for b in range(a):
            cell = coarse[a][bins[fit, a]] * side + coarse[b][bins[fit, b]]
            grid = [np.bincount(cell, v, side * side).reshape(side, side) for v in (g, h)]
            gains.append((_grid_tree(*grid)[0], a, b))
    model.pairs = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:PAIRS] if gain > 1e-9]
    model.grids = np.zeros((len(model.pairs), side, side))
    cells = [coarse[a][bins[:, a]] * side + coarse[b][bins[:, b]] for a, b in model.pairs]

    def pair_tree(g, h):
        return _grid_tree(g.reshape(side, side), h.reshape(side, side))[1]

    if cells:
        cycles(model.grids, cells, pair_tree, side * side)
    return model


def training_rows(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents and labels whose id has a remainder other than 1."""
    taught = remainder(F.col("doc_id"), 3) != 1
    return documents.filter(taught), labels.filter(taught)


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Learn from documents (doc_id, text) and labels (doc_id, quality) of the training rows."""
    marked = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg(F.max(F.when(F.col("quality") != 0, 1).otherwise(0)).alias("quality"))
    )
    shares = dict(marked.groupBy("quality").count().collect())
    n_good, n_poor = shares.get(1, 0), shares.get(0, 0)
    prior = (n_good + 0.5) / (n_good + n_poor + 1)
    # ids below a threshold of their hash: a sample of known expected size, without a sort
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality")), F.lit(1 << 40)) / float(1 << 40)
    rate = F.when(F.col("quality") == 1, min(1.0, TRAIN_DOCS / max(n_good, 1))).otherwise(min(1.0, TRAIN_DOCS / max(n_poor, 1)))
    sample = marked.filter(place < rate)
    columns = ", ".join(f"{name} double" for name in FEATURES)

    def measure(batches):
        for piece in pieces(batches):
            x = measures(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("quality"), *(pa.array(x[:, j]) for j in range(len(FEATURES)))],
                names=["doc_id", "quality", *FEATURES],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    taught = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    taught = taught.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = taught.mapInArrow(measure, f"doc_id {kind}, quality int, {columns}").toPandas()
    # one order, whatever tasks ended first
    rows = rows.sort_values(["doc_id", *FEATURES], kind="stable", ignore_index=True)
    order = np.random.default_rng(13).permutation(len(rows))
    x, y = rows[FEATURES].to_numpy(np.float64)[order], rows["quality"].to_numpy(np.float64)[order]
    share = y.mean() if len(y) else prior
    weight = np.where(y == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    return train(x, y, weight, prior)


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

    rows = documents.select("doc_id", "text", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
