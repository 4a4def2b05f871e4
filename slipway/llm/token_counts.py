"""Token counts of a unigram tokenizer, without building the tokens."""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from slipway.llm.frames import identified_texts, slices

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
# Stretches of text that a worker remembers; beyond that it keeps those that the texts at hand need.
MOST_KNOWN = 500_000
# What a character without a piece costs beyond the worst piece.
UNKNOWN_COST = 10.0


class Counter:
    """A vocabulary of (piece, score) as an automaton."""

    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece and piece not in self.automaton:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_COST
        pieces = {piece for piece, _ in vocabulary}
        self.has_bytes = all(f"<0x{value:02X}>" in pieces for value in range(256))
        # Scores add up alike from any start only if they are whole; a cut before a space mark changes nothing only if
        # no piece holds one after another character and the mark itself is a piece.
        whole = all(score == int(score) for _, score in vocabulary)
        self.cuts = whole and SPACE in pieces and not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces)
        # Of stretches that stand after a space mark, which is left out here.
        self.counts: dict[str, int] = {}
        self.scores: dict[str, float] = {}

    def count(self, stretch: str) -> tuple[int, float]:
        """Pieces on the best path through ``stretch``, and its score.

        The automaton names the pieces that end at each place. Of equal scores the path whose last piece begins first
        wins; a single character without a piece costs ``unknown`` and loses against equals. Such a character counts as
        its bytes, or, where the vocabulary has none, as one piece with its neighbours of the same kind.
        """
        size = len(stretch)
        scores, counts, lone = [-math.inf] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        scores[0] = 0.0
        alone, ready = [False] * (size + 1), 0

        def settle(upto: int) -> None:
            for end in range(ready + 1, upto + 1):
                total = scores[end - 1] + self.unknown
                if not alone[end] and total > scores[end]:
                    more = len(stretch[end - 1].encode()) if self.has_bytes else not lone[end - 1]
                    scores[end], counts[end], lone[end] = total, counts[end - 1] + more, True

        # Of the pieces that end at a place, the automaton names the longest first.
        for last, (length, score) in self.automaton.iter(stretch):
            if last > ready:
                settle(last)
                ready = last
            total = scores[last + 1 - length] + score
            if total > scores[last + 1]:
                scores[last + 1], counts[last + 1] = total, counts[last + 1 - length] + 1
            if length == 1:
                alone[last + 1] = True
        settle(size)
        return counts[-1], scores[-1]

    def totals(self, texts: list[str]) -> list[tuple[int, float]]:
        """The same for whole texts, with a space mark in the place of each space and one before the text."""
        cut = []
        for text in texts:
            if not text:
                cut.append([])
            elif not self.cuts:
                cut.append([text.replace(" ", SPACE)])
            elif "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
                marked = SPACE + text.replace(" ", SPACE)
                cut.append([stretch[1:] for stretch in re.findall(f"{SPACE}+[^{SPACE}]*", marked)])
            else:
                cut.append(text.split(" "))
        needed = set().union(*cut)
        if len(self.counts) + len(needed) > MOST_KNOWN:
            kept = needed & self.counts.keys()
            self.counts = {stretch: self.counts[stretch] for stretch in kept}
            self.scores = {stretch: self.scores[stretch] for stretch in kept}
        for stretch in needed - self.counts.keys():
            self.counts[stretch], self.scores[stretch] = self.count(SPACE + stretch)
        return [(sum(map(self.counts.__getitem__, x)), sum(map(self.scores.__getitem__, x), 0.0)) for x in cut]


def read_vocabulary(model: str = MODEL) -> list[tuple[str, float]]:
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    return [(pieces.id_to_piece(number), pieces.get_score(number)) for number in range(pieces.vocab_size())]


@functools.lru_cache(maxsize=1)
def counter(model: str) -> Counter:
    """One for each Python worker."""
    return Counter(read_vocabulary(model))


def token_counts(
    table: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL
) -> DataFrame:
    """One row per row of ``table``: its id, ``n_tokens`` and ``score`` of the unigram path over ``model``'s pieces.

    A row is counted where it is read, without a shuffle. A worker looks each stretch between space marks up, or, the
    first time, runs the automaton and the dynamic programme over it; a stretch's length only matters in proportion. A
    null text counts as empty: no tokens, score 0. Repeated rows come back each, a null id stays null, an empty table
    gives no rows, other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model)
        for batch in slices(batches):
            counts, scores = zip(*own.totals(batch["text"].to_pylist()), strict=True)
            columns = [batch["id"], pa.array(counts, pa.int64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "score"])

    found = identified_texts(table, id_column, text_column).mapInArrow(run, "id long, n_tokens long, score double")
    return found.withColumnRenamed("id", id_column)
