"""Token counts under a unigram vocabulary: Viterbi without keeping the path.

The pieces and scores of a vocabulary file segment a text so that the sum of scores
is greatest.  An Aho-Corasick automaton lists the pieces that end at each character, the
longest first; dynamic programming carries only the best score and the number of
pieces on it.  Ties go to the piece found first, which is the longest, and an unknown
character (ten below the least score) is tried last, as unigram tokenizers do; unknown
characters cost one token per UTF-8 byte (byte pieces), or one per stretch without them.

White space is written as a mark in front of a word, and no piece has the mark behind
another character, so every best path passes through the word starts: words are
counted apart, each spelling once per batch, and the counts added up.

Defined results: null and empty texts have no tokens; repeated rows come out repeated;
other columns are ignored.  The vocabulary file is named by a parameter and read on
the driver only; tasks receive its pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.words import pieces, row_sums, translated

MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 300_000
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_SAME = np.arange(256, dtype=np.uint8)


@dataclass
class Vocabulary:
    scores: dict[str, float]
    byte_fallback: bool


def load(path: str) -> Vocabulary:
    """The ordinary pieces and scores of a SentencePiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_byte, model.is_unknown, model.is_control, model.is_unused)
    scores = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size()) if not any(test(i) for test in special)
    }
    if any(MARK in piece.lstrip(MARK) for piece in scores):
        raise ValueError("a piece goes on beyond the end of a word")
    return Vocabulary(scores, any(model.is_byte(i) for i in range(model.get_piece_size())))


class Counter:
    """Counts pieces of words; remembers the words counted last."""

    def __init__(self, vocabulary: Vocabulary):
        self.byte_fallback = vocabulary.byte_fallback
        self.unknown = min(vocabulary.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p in vocabulary.scores if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.known: dict[str, int] = {}

    def __call__(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = self._count(word)
        return found

    def _count(self, word: str) -> int:
        n = len(word)
        ends: list[list] = [[] for _ in range(n + 1)]
        if len(self.automaton):
            for end, match in self.automaton.iter(word):
                ends[end + 1].append(match)
        best = [0.0] + [None] * n
        count = [0] * (n + 1)
        open_unknown = [False] * (n + 1)
        for end in range(1, n + 1):
            top = None
            for length, score in ends[end]:  # the automaton lists the longest first
                value = best[end - length] + score
                if top is None or value > top:
                    top, count[end], open_unknown[end] = value, count[end - length] + 1, False
            if word[end - 1] not in self.single:
                value = best[end - 1] + self.unknown
                if top is None or value > top:
                    top, open_unknown[end] = value, True
                    if self.byte_fallback:
                        count[end] = count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
                    else:
                        count[end] = count[end - 1] + (not open_unknown[end - 1])
            best[end] = top
        return count[n]

    def text(self, text: str) -> int:
        return sum(self(chunk) for chunk in _CHUNK.findall(MARK + text.replace(" ", MARK))) if text else 0


def count_tokens(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens of every document."""
    shipped = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shipped.value)
        for piece in pieces(batches):
            texts = translated(piece.column("text"), _SAME)
            # texts with runs of spaces, at their ends or MARKs of their own are cut by the general rule
            odd = pc.or_(pc.match_substring_regex(texts, "^ | $|  "), pc.match_substring(texts, MARK))
            odd = odd.to_numpy(zero_copy_only=False)
            lists = pc.split_pattern(texts, " ")
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            words = lists.flatten().dictionary_encode()
            spelled = np.array([counter(MARK + w) if w else 0 for w in words.dictionary.to_pylist()], np.int64)
            rows = np.repeat(np.arange(len(texts)), lengths)
            codes = words.indices.to_numpy(zero_copy_only=False)
            total = row_sums(spelled[codes], rows, len(texts)).astype(np.int64)
            for i in np.flatnonzero(odd):
                total[i] = counter.text(texts[int(i)].as_py())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(total)], names=["doc_id", "n_tokens"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long")
