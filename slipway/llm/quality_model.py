"""A quality scorer trained on what overlapping heuristics agree on, without any given labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.frames import identified_texts, slices, stored
from slipway.llm.words import Words, mix

BAD, UNSURE, GOOD = 0, 1, 2
# Documents that the scorer is fitted on at most, those whose texts hash lowest.
SAMPLE = 4_000
BUCKETS = 4_096
EM_ROUNDS = 50
FIT_ROUNDS = 300
LEAST_SCORE = 0.5
# Labellers call a text bad with care: of good texts, no more than this part. Without that bound the one kind of bad text
# that most labellers see would pass for all of them.
MOST_ALARMS = 0.01

# What each heuristic looks at, up to where it calls a text good, and from where on bad.
LABELLERS = {
    "symbols": (0.02, 0.10),  # characters of #*$%&|<> for each word
    "stutter": (0.05, 0.20),  # words equal to the word before
    "same_pairs": (0.20, 0.50),  # word pairs that the text already had
    "shortness": (1 / 50, 1 / 12),  # one over the number of words
    "odd_size": (2.5, 6.0),  # how far the mean word is from 5 bytes
    "marked_words": (0.15, 0.50),  # words that do not end with a letter, a digit, or . , ; : ? !
}

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_PLAIN_END = np.ones(256, bool)
_PLAIN_END[[byte for byte in range(128) if not chr(byte).isalnum() and chr(byte) not in ".,;:?!'\")"]] = False


def _sums(values: np.ndarray, words: Words) -> np.ndarray:
    """The sum of ``values``, one for each word, by text."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[words.first[1:]] - total[words.first[:-1]]


def measures(words: Words) -> np.ndarray:
    """A row for each text, a column for each labeller; texts without words have the worst of each."""
    counts = np.diff(words.first)
    least = np.maximum(counts, 1)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[words.data])])
    symbols = symbols[words.begins[1:]] - symbols[words.begins[:-1]]
    same_text = words.texts[1:] == words.texts[:-1]
    stutter = np.zeros(len(words.hashes), np.int64)
    stutter[1:] = same_text & (words.hashes[1:] == words.hashes[:-1])
    pairs, places = words.shingles(2)
    order = np.lexsort((pairs, words.texts[places]))
    again = np.zeros(len(words.hashes), np.int64)
    if len(order) > 1:
        here, there = order[1:], order[:-1]
        equal = (pairs[here] == pairs[there]) & (words.texts[places[here]] == words.texts[places[there]])
        again[places[here[equal]]] = 1
    marked = (~_PLAIN_END[words.data[words.ends - 1]]).astype(np.int64)
    rows = np.stack(
        [
            symbols / least,
            _sums(stutter, words) / least,
            _sums(again, words) / least,
            1 / least,
            np.abs(_sums(words.ends - words.starts, words) / least - 5),
            _sums(marked, words) / least,
        ],
        axis=1,
    )
    rows[counts == 0] = np.inf
    return rows


def votes(rows: np.ndarray) -> np.ndarray:
    good, bad = np.array([*LABELLERS.values()]).T
    return np.where(rows <= good, GOOD, np.where(rows >= bad, BAD, UNSURE)).astype(np.int8)


def patterns(texts: DataFrame) -> DataFrame:
    """``votes`` (a digit for each labeller) and the number ``n`` of documents that got them.

    There are three answers, so 3 to the number of labellers patterns at most, however many documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = votes(measures(Words.of(batch["text"].to_pylist())))
            yield pa.RecordBatch.from_arrays([pa.array(["".join(map(str, row)) for row in found.tolist()])], ["votes"])

    return texts.mapInArrow(run, "votes string").groupBy("votes").agg(F.count("*").alias("n"))


@dataclass
class LabelModel:
    """How often texts are good, and how often each labeller gives each answer for bad and for good ones."""

    good: float
    answers: np.ndarray  # labeller, truth, answer

    def posterior(self, found: np.ndarray) -> np.ndarray:
        """The probability that texts with these answers are good; the labellers err independently."""
        which = np.arange(self.answers.shape[0])
        bad, good = (np.log(self.answers[which, truth, found]).sum(axis=1) for truth in (0, 1))
        return 1 / (1 + np.exp(np.clip(bad + np.log1p(-self.good) - good - np.log(self.good), -500, 500)))


def fit_labels(found: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> LabelModel:
    """Expectation-maximisation over answer patterns and how many texts have each.

    It begins with the majority of the answers. Each round weighs every pattern by the probability that its texts are
    good, then sets the model to those weights; one text of each kind is added throughout, so that nothing is ruled out.
    """
    labellers = found.shape[1]
    weight = np.clip(0.5 + (found - 1.0).sum(axis=1) / (2 * labellers), 0.05, 0.95)
    model = LabelModel(0.5, np.full((labellers, 2, 3), 1 / 3))
    for _ in range(rounds):
        sides = np.stack([counts * (1 - weight), counts * weight])
        answers = np.stack(
            [[[side[found[:, k] == answer].sum() + 1 for answer in range(3)] for side in sides] for k in range(labellers)]
        )
        answers = answers / answers.sum(axis=2, keepdims=True)
        alarms = np.minimum(answers[:, 1, BAD], MOST_ALARMS)
        answers[:, 1, :] *= ((1 - alarms) / (1 - answers[:, 1, BAD]))[:, None]
        answers[:, 1, BAD] = alarms
        model = LabelModel((sides[1].sum() + 1) / (counts.sum() + 2), answers)
        weight = model.posterior(found)
    return model


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each text ``BUCKETS`` shares of its hashed byte triples and word pairs, as (text and bucket, share).

    Byte triples tell ordinary from marked words, whatever the words; equal neighbours have a bucket of their own.
    """
    data = words.data.astype(np.uint64)
    triples = data[:-2] | (data[1:-1] << np.uint64(8)) | (data[2:] << np.uint64(16))
    with np.errstate(over="ignore"):
        buckets = (mix(triples + np.uint64(1)) >> np.uint64(52)).astype(np.int64)
    owners = np.repeat(np.arange(len(words.begins) - 1), np.diff(words.begins))
    # A triple ends within its text, so that a text's shares do not depend on the text that follows in its batch.
    within = owners[:-2] == owners[2:]
    keys = owners[:-2][within] * BUCKETS + buckets[within]
    same = (words.texts[1:] == words.texts[:-1]) & (words.hashes[1:] == words.hashes[:-1])
    keys = np.concatenate([keys, np.repeat(words.texts[1:][same] * BUCKETS, 8)])
    found, counts = np.unique(keys, return_counts=True)
    total = np.bincount(found // BUCKETS, counts, len(words.begins) - 1)
    return found, counts / total[found // BUCKETS]


@dataclass
class Scorer:
    """A linear score over hashed features, as a probability."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        words = Words.of(texts)
        keys, shares = features(words)
        total = np.bincount(keys // BUCKETS, self.weights[keys % BUCKETS] * shares, len(texts))
        found = 1 / (1 + np.exp(-np.clip(total + self.bias, -500, 500)))
        found[np.diff(words.first) == 0] = 0.0
        return found


def fit_scorer(rows: list[tuple[list[int], list[float], float]], rounds: int = FIT_ROUNDS) -> Scorer:
    """Logistic regression on (buckets, shares, probability of good), both kinds weighing the same in all. No rows: all score 1/2."""
    if not rows:
        return Scorer(np.zeros(BUCKETS), 0.0)
    matrix = np.zeros((len(rows), BUCKETS), np.float32)
    for row, (buckets, shares, _) in zip(matrix, rows, strict=True):
        row[buckets] = shares
    truth = np.array([row[2] for row in rows], np.float32)
    scale = np.sqrt((matrix**2).mean(axis=0)) + 1e-3
    matrix /= scale
    weight = np.where(truth >= 0.5, 0.5 / max(truth.sum(), 1), 0.5 / max((1 - truth).sum(), 1)).astype(np.float32)
    weights, bias, rate = np.zeros(BUCKETS, np.float32), 0.0, 0.5 / max((matrix**2).sum(axis=1).mean(), 1)
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-np.clip(matrix @ weights + bias, -30, 30)))
        error = (guess - truth) * weight
        weights -= rate * 4 * (matrix.T @ error + 1e-5 * weights)
        bias -= rate * 4 * float(error.sum())
    return Scorer((weights / scale).astype(np.float64), bias)


def train(texts: DataFrame, sample: int = SAMPLE) -> tuple[LabelModel, Scorer]:
    """Both models for documents ``id`` and ``text``.

    The label model sees the answers about all documents, as counts of patterns. The scorer is fitted on ``sample``
    different texts at most, those that hash lowest, whatever their ids; only their feature shares reach the driver. A
    text counts once there, however many rows repeat it. Without any text there is no scorer to fit, and an error.
    """
    found = stored(patterns(texts), "patterns").toPandas()
    answers = np.array([[int(digit) for digit in row] for row in found["votes"]], np.int8).reshape(-1, len(LABELLERS))
    counts = found["n"].to_numpy(np.float64)
    order = np.lexsort(answers.T)
    labels = fit_labels(answers[order], counts[order])
    hashed = texts.select("text", F.xxhash64("text", F.lit("sample")).alias("hash"))
    # Twice as many as are wanted, by an estimate of the number of different texts; the lowest of them stay.
    different = max(1, hashed.agg(F.approx_count_distinct("hash")).first()[0])
    part = min(1.0, 2 * sample / different)
    picked = hashed.where(F.col("hash") <= F.lit(int((part * 2 - 1) * ((1 << 63) - 1)))) if part < 1 else hashed
    lowest = stored(picked.select("hash").distinct().orderBy("hash").limit(sample), "lowest")
    highest = lowest.agg(F.max("hash")).first()[0]
    if highest is None:
        raise ValueError("no text to fit the scorer on")
    picked = hashed.where(F.col("hash") <= F.lit(highest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            hashes = batch["hash"].to_pylist()
            new = [at for at, key in enumerate(hashes) if not (key in seen or seen.add(key))]
            for part in slices([batch.take(pa.array(new, pa.int64()))]) if new else ():
                words = Words.of(part["text"].to_pylist())
                truth = labels.posterior(votes(measures(words)))
                keys, shares = features(words)
                cuts = np.searchsorted(keys, np.arange(len(truth) + 1) * BUCKETS)
                rows = [(keys[a:b] % BUCKETS, shares[a:b].astype(np.float32)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [pa.array([row[side] for row in rows], kind) for side, kind in ((0, pa.list_(pa.int64())), (1, pa.list_(pa.float32())))]
                yield pa.RecordBatch.from_arrays([part["hash"], *columns, pa.array(truth)], ["hash", "buckets", "shares", "truth"])

    spread = picked.mapInArrow(run, "hash long, buckets array<long>, shares array<float>, truth double")
    rows = stored(spread, "sample").toPandas().drop_duplicates("hash").sort_values("hash")
    return labels, fit_scorer([*zip(rows["buckets"], rows["shares"], rows["truth"], strict=True)])


def quality_scores(table: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``table``: its id, ``score`` (0 to 1) and ``kept`` (``LEAST_SCORE`` or more).

    Six heuristics call each text good, bad or neither; expectation-maximisation estimates how often each one errs, and
    the labels that follow train a linear scorer on hashed features, which then scores every whole text. No given labels
    are used. A null text counts as empty; texts without words score 0. Repeated rows come back each, a null id stays
    null, an empty table gives no rows, other columns are left out.
    """
    texts = identified_texts(table, id_column, text_column)
    schema = "id long, score double, kept boolean"
    if texts.isEmpty():
        return table.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_column)
    _, scorer = train(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = scorer.scores(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found), pa.array(found >= LEAST_SCORE)], ["id", "score", "kept"])

    return texts.mapInArrow(run, schema).withColumnRenamed("id", id_column)
