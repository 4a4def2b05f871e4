"""Passages of a benchmark in documents, by SimHash of windows of the items' sizes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from slipway.llm.frames import hamming, identified_texts, slices, stored
from slipway.llm.words import Words

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Fingerprints are cut into blocks, one of which differs in so few bits if all differ in RADIUS or fewer. Bags that
# share 0.8 of their weight differ in 13 of 64 bits on average, with a deviation of 3.2.
BLOCKS, BLOCK_RADIUS = 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
# Benchmark items that tasks hold at once; more are searched for in several passes over the documents.
PASS_ITEMS = 20_000

_BLOCK_BITS = 64 // BLOCKS
_FLIPS = [
    sum(1 << bit for bit in bits) for many in range(BLOCK_RADIUS + 1) for bits in combinations(range(_BLOCK_BITS), many)
]


def _weight(words: int) -> int:
    """How many shingles a text of so many words has; a shorter text is one shingle."""
    return max(words - SHINGLE_WORDS + 1, min(words, 1))


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    """One fingerprint for each row of hashes: a bit is 1 if more than half of them have it."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(*hashes.shape, 8), axis=2, bitorder="little")
    return np.packbits(bits.sum(axis=1, dtype=np.int32) * 2 > hashes.shape[1], axis=1, bitorder="little").view(np.int64)[:, 0]


class _Items:
    """The benchmark items of a pass: for each size in words, the hashes of its items' shingles."""

    def __init__(self, rows: list[Row]) -> None:
        words = Words.of([row["text"] for row in rows])
        sizes = np.diff(words.first)
        self.by_size: dict[int, np.ndarray] = {}
        self.rows: list[tuple[int, int, int, str]] = []
        for size in sorted(set(sizes.tolist()) - {0}):
            hashes, places = words.shingles(min(size, SHINGLE_WORDS))
            own = np.flatnonzero(sizes[words.texts[places]] == size)
            table = hashes[own].reshape(-1, _weight(size))
            self.by_size[size] = np.unique(table)
            items = np.flatnonzero(sizes == size)
            for item, fingerprint in zip(items, _fingerprints(np.ascontiguousarray(table)), strict=True):
                self.rows.append((rows[item]["id"], size, int(fingerprint), rows[item]["text"]))

    def windows(self, words: Words) -> Iterator[tuple[int, int, int, int, str]]:
        """Text, first word, size, fingerprint and wording of each window of an item's size that could be similar.

        A window shares at most as much of an item's weight as it has shingles of items of that size. That bound leaves
        out only windows that no item of the size could be similar to; all words of all texts are compared.
        """
        shingles: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, known in self.by_size.items():
            span = min(size, SHINGLE_WORDS)
            if span not in shingles:
                hashes, places = words.shingles(span)
                union = np.unique(np.concatenate([own for n, own in self.by_size.items() if min(n, SHINGLE_WORDS) == span]))
                marks = np.zeros(1 << 20, bool)
                marks[union & np.uint64((1 << 20) - 1)] = True
                near = np.flatnonzero(marks[hashes & np.uint64((1 << 20) - 1)])
                near = near[np.isin(hashes[near], union)]
                shingles[span] = hashes, places, near
            hashes, places, near = shingles[span]
            near = near[np.isin(hashes[near], known)]
            if not len(near):
                continue
            weight = _weight(size)
            least = int(np.ceil(SIMILARITY * weight - 1e-9))
            # Places of shingles are words; texts shorter than the size are a window by themselves.
            hit = places[near]
            texts = words.texts[hit]
            for text in np.unique(texts):
                low, high = words.first[text], words.first[text + 1]
                own = hit[texts == text]
                last = max(high - size, low)
                begins = np.arange(max(low, own[0] - weight + 1), min(last, own[-1]) + 1)
                if not len(begins):
                    begins = np.array([low])
                found = np.searchsorted(own, begins + weight) - np.searchsorted(own, begins)
                begins = begins[found >= least]
                count = min(weight, _weight(int(high - low)))
                if not len(begins) or count <= 0:
                    continue
                at = np.searchsorted(places, begins)
                prints = _fingerprints(np.ascontiguousarray(hashes[at[:, None] + np.arange(count)]))
                for begin, fingerprint in zip(begins.tolist(), prints.tolist(), strict=True):
                    end = min(begin + size, int(high)) - 1
                    wording = words.data[words.starts[begin] : words.ends[end]].tobytes().decode()
                    yield int(text), int(begin - low), size, fingerprint, wording


def similarity(window: str, item: str) -> float:
    """The part of the item's shingles, each as often as it occurs, that the window has too."""

    def bag(text: str) -> Counter:
        words = text.encode().lower().split()
        size = min(len(words), SHINGLE_WORDS)
        return Counter(zip(*(words[at:] for at in range(size)), strict=False))

    item_bag = bag(item)
    return (item_bag & bag(window)).total() / max(item_bag.total(), 1)


def _block(number: Column) -> Column:
    mask = (1 << _BLOCK_BITS) - 1
    return F.call_function("shiftrightunsigned", F.col("fingerprint"), number * _BLOCK_BITS).bitwiseAND(F.lit(mask).cast("long"))


def _passages(texts: DataFrame, items: _Items) -> DataFrame:
    """``id``, ``item_id``, ``start_word``, ``n_words`` and ``similarity`` of all similar windows and items."""
    spark = texts.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch["id"].to_pylist()
            rows = [(ids[text], *row) for text, *row in items.windows(Words.of(batch["text"].to_pylist()))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names
                )

    names = ["id", "start_word", "size", "fingerprint", "wording"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
    schema = "id long, start_word int, size int, fingerprint long, wording string"
    windows = stored(texts.mapInArrow(cut, schema), "windows")
    number = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    windows = windows.select("*", number).withColumn("value", _block(F.col("block")))
    known = spark.createDataFrame(items.rows, "item_id long, size int, fingerprint long, text string")
    flips = F.explode(F.array(*map(F.lit, _FLIPS))).alias("flip")
    index = known.select("*", number).select("*", flips).withColumn("value", _block(F.col("block")).bitwiseXOR(F.col("flip").cast("long")))
    index = index.select("item_id", "size", "block", "value", "text", F.col("fingerprint").alias("item_fingerprint"))
    near = windows.join(index, ["size", "block", "value"]).where(hamming("fingerprint", "item_fingerprint") <= RADIUS)
    # Of the blocks by which a pair is found, the first one counts.
    earlier = F.lit(False)
    for block in range(BLOCKS - 1):
        differing = F.bit_count(_block(F.lit(block)).bitwiseXOR(_item_block(block)))
        earlier = earlier | ((F.col("block") > block) & (differing <= BLOCK_RADIUS))
    near = near.where(~earlier).select("id", "item_id", "start_word", F.col("size").alias("n_words"), "wording", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [*map(similarity, batch["wording"].to_pylist(), batch["text"].to_pylist())]
            columns = [batch[name] for name in ("id", "item_id", "start_word", "n_words")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], ["id", "item_id", "start_word", "n_words", "similarity"])

    verified = near.mapInArrow(verify, "id long, item_id long, start_word int, n_words int, similarity double")
    return verified.where(F.col("similarity") >= SIMILARITY)


def _item_block(block: int) -> Column:
    mask = (1 << _BLOCK_BITS) - 1
    return F.call_function("shiftrightunsigned", F.col("item_fingerprint"), F.lit(block * _BLOCK_BITS)).bitwiseAND(F.lit(mask).cast("long"))


def benchmark_passages(table: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item of which it holds a similar passage: ``doc_id``, ``item_id``,
    ``start_word`` and ``n_words`` of the most similar window (the first of several) and its ``similarity``.

    ``table`` has ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``. Texts are lower-cased (A-Z) and cut
    at ASCII white space. For every size that an item has, all windows of so many words are bounded by the shingles of
    five words that they share with items; those that could reach ``SIMILARITY`` get a fingerprint. Fingerprints that
    differ in ``RADIUS`` bits or fewer agree, in one of eight blocks, but for two bits, so the equality join on blocks
    finds all such pairs. The wording of each pair decides. A text shorter than an item is a window by itself.

    Tasks hold ``PASS_ITEMS`` items at once; a larger benchmark takes more passes. Null texts and items without words
    match nothing. Rows that repeat a doc_id count as one document. Empty tables give no rows. Other columns are left
    out. Fingerprints of bags that share just 0.8 may, rarely, differ in more bits; the README has the measured recall.
    """
    texts = identified_texts(table, "doc_id", "text")
    items = identified_texts(benchmark, "item_id", "text")
    passes = max(1, -(-items.count() // PASS_ITEMS))
    found: DataFrame | None = None
    for turn in range(passes):
        rows = items.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == turn).collect()
        if rows := [row for row in rows if row["text"].split()]:
            some = _passages(texts, _Items(rows))
            found = some if found is None else found.union(some)
    if found is None:
        found = table.sparkSession.createDataFrame([], "id long, item_id long, start_word int, n_words int, similarity double")
    best = F.max(F.struct("similarity", (-F.col("start_word")).alias("before"), "n_words")).alias("best")
    return found.groupBy("id", "item_id").agg(best).select(
        F.col("id").alias("doc_id"), "item_id", (-F.col("best.before")).alias("start_word"), "best.n_words", "best.similarity"
    )


def without_leaks(table: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``table`` whose document holds no passage of ``benchmark``. Rows without a doc_id stay."""
    leaks = stored(benchmark_passages(table, benchmark).select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    return table.join(leaks, table["doc_id"] == leaks["_leak"], "left_anti")
