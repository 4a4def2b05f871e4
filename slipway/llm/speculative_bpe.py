"""Byte-level BPE by guessing tokens, checking all neighbours at once, and merging only where the guess fails."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from slipway.llm.frames import identified_texts, slices
from slipway.llm.pretokens import Memory

MODEL = public_tokenizers.path("byte_bpe_50k.json")
# Words that a Python worker remembers.
MOST_KNOWN = 400_000
# Neither a byte nor part of any token: stands between words that are guessed together.
_BREAK = "Ā"
_NEVER = np.int64(1) << np.int64(40)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such vocabularies: printable Latin-1 ones are themselves, the rest follow."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [value for value in range(256) if value not in own]
    return {chr(value): value for value in own} | {chr(256 + place): value for place, value in enumerate(others)}


@dataclass
class Model:
    """Tokens as bytes, by id; merges as (left, right, made) in order of rank; special tokens, by text."""

    tokens: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Model:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        letters, vocabulary = byte_letters(), whole["model"]["vocab"]
        pairs = [tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in whole["model"]["merges"]]
        special = {token["content"]: token["id"] for token in whole["added_tokens"]}
        tokens = {number: bytes(letters[letter] for letter in token) for token, number in vocabulary.items() if token not in special}
        merges = [(vocabulary[left], vocabulary[right], vocabulary[left + right]) for left, right in pairs]
        return cls(tokens | {number: text.encode() for text, number in special.items()}, merges, special)


class Encoder:
    """Encodes words by ``model``.

    Every merge makes a token that no other merge makes, out of tokens made before; so a token has one left and one right
    part, and it was made at the rank of its merge.
    """

    def __init__(self, model: Model) -> None:
        self.model = model
        left, right, made = (np.array(column, np.int64) for column in zip(*model.merges, strict=True))
        count = max(model.tokens) + 1
        if len(set(made.tolist())) != len(made):
            raise ValueError("two merges make the same token")
        self.born = np.full(count, -1, np.int64)
        self.born[made] = np.arange(len(made))
        if (self.born[left] >= self.born[made]).any() or (self.born[right] >= self.born[made]).any():
            raise ValueError("a merge is of tokens that are made after it")
        # A token's parts; a byte has none.
        self.left, self.right = np.full(count, -1, np.int64), np.full(count, -1, np.int64)
        self.left[made], self.right[made] = left, right
        keys = left << 32 | right
        order = np.argsort(keys)
        self.pairs, self.ranks = keys[order], order.astype(np.int64)
        self.made = made
        special = set(model.special.values())
        self.base = np.zeros(256, np.int64)
        for number, own in model.tokens.items():
            if len(own) == 1 and number not in special:
                self.base[own[0]] = number
        # Tokens that the merges make of their own bytes; the others are never guessed.
        whole = np.ones(count, bool)
        whole[made] = self.compatible(left, right, np.arange(len(made)))
        for parent in made.tolist():
            whole[parent] &= whole[self.left[parent]] and whole[self.right[parent]]
        self.ids = {
            own: number for number, own in model.tokens.items() if number not in special and whole[number]
        }
        self.guesser = ahocorasick.Automaton()
        for own, number in self.ids.items():
            self.guesser.add_word(own.decode("latin-1"), number)
        self.guesser.make_automaton()
        self.decimals = [b"%d," % number for number in range(count)]
        self.merge_of = {(a, b): (rank, c) for rank, (a, b, c) in enumerate(model.merges)}
        # Of words that were guessed, how many failed.
        self.guessed = self.failed = 0

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` side by side stay apart, for each pair.

        They do if no merge joins a part that ends ``a`` to a part that begins ``b`` while both are there. Going back from
        the whole tokens, the one made last is taken apart first. A part lasts until its own merge, so a merge across
        comes first if its rank is less than that of ``a``'s part's, or not more than that of ``b``'s: of equal ranks the
        leftmost merges first. Merges of rank ``until`` or more are not looked at.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        apart = np.ones(len(a), bool)
        at = np.arange(len(a))
        limit = np.full(len(a), _NEVER) if until is None else until.astype(np.int64)
        end_a, end_b = limit.copy(), limit - 1
        while len(at):
            keys = a << 32 | b
            place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            rank = np.where(self.pairs[place] == keys, self.ranks[place], _NEVER)
            joined = (rank < end_a) & (rank <= end_b)
            apart[at[joined]] = False
            born_a, born_b = self.born[a], self.born[b]
            going = ~joined & ((born_a >= 0) | (born_b >= 0))
            # Of two equal tokens the left one was made first.
            later_a = born_a > born_b
            end_a, end_b = np.where(later_a, born_a, end_a), np.where(later_a, end_b, born_b)
            a, b = np.where(later_a, self.right[a], a), np.where(later_a, b, self.left[b])
            at, a, b, end_a, end_b = at[going], a[going], b[going], end_a[going], end_b[going]
        return apart

    def guesses(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """From each word's start the longest token, and so on: all tokens in a row, and where each word's begin."""
        text = _BREAK.join([word.decode("latin-1") for word in words])
        ends = np.cumsum([len(word) + 1 for word in words]) - 2
        found = [*self.guesser.iter_long(text)]
        last, tokens = (np.array(column, np.int64) for column in zip(*found, strict=True))
        return tokens, np.concatenate([np.zeros(1, np.int64), np.searchsorted(last, ends, side="right")])

    def merged(self, word: bytes) -> list[int]:
        """The tokens of a word by its merges, the least rank first and of these the leftmost.

        A heap holds the pairs by rank and place; those whose tokens have changed since are passed over.
        """
        tokens = self.base[np.frombuffer(word, np.uint8)].tolist()
        size = len(tokens)
        after, before = [*range(1, size + 1)], [*range(-1, size - 1)]
        heap = [
            (found[0], at, found[1]) for at in range(size - 1) if (found := self.merge_of.get((tokens[at], tokens[at + 1])))
        ]
        heapq.heapify(heap)
        while heap:
            rank, at, made = heapq.heappop(heap)
            second = after[at]
            if tokens[at] < 0 or second >= size or self.merge_of.get((tokens[at], tokens[second]), (-1,))[0] != rank:
                continue
            tokens[at], tokens[second] = made, -1
            after[at] = third = after[second]
            if third < size:
                before[third] = at
                if found := self.merge_of.get((made, tokens[third])):
                    heapq.heappush(heap, (found[0], at, found[1]))
            if (first := before[at]) >= 0 and (found := self.merge_of.get((tokens[first], made))):
                heapq.heappush(heap, (found[0], first, found[1]))
        return [token for token in tokens if token >= 0]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The tokens of each word."""
        rest = [word for word in words if word and word not in self.ids]
        found: dict[bytes, list[int]] = {}
        if rest:
            tokens, starts = self.guesses(rest)
            pairs, inverse = np.unique(tokens[:-1] << 32 | tokens[1:], return_inverse=True)
            apart = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[inverse]
            apart[starts[1:-1] - 1] = True  # neighbours of different words
            wrong = np.concatenate([np.zeros(1, np.int64), np.cumsum(~apart)])
            failed = wrong[np.maximum(starts[1:] - 1, starts[:-1])] > wrong[starts[:-1]]
            self.guessed, self.failed = self.guessed + len(rest), self.failed + int(failed.sum())
            numbers, edges = tokens.tolist(), starts.tolist()
            for at, (word, fails) in enumerate(zip(rest, failed.tolist(), strict=True)):
                found[word] = self.merged(word) if fails else numbers[edges[at] : edges[at + 1]]
        return [[] if not word else found[word] if word in found else [self.ids[word]] for word in words]

    def decode(self, tokens: Iterable[int]) -> bytes:
        return b"".join([self.model.tokens[token] for token in tokens])


class Codec:
    """An encoder with what its worker has encoded so far."""

    def __init__(self, path: str) -> None:
        self.encoder = Encoder(Model.read(path))
        self.memory = Memory(self._answers, 2, MOST_KNOWN)

    def _answers(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        decimals = self.encoder.decimals
        return [
            (b"".join([decimals[token] for token in tokens]), self.encoder.decode(tokens))
            for tokens in self.encoder.encode([word.encode() for word in words])
        ]

    def round_trips(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids, each in decimals with a comma after it, and the bytes that these stand for.

        A special token's text is that token wherever it stands, and the words before and after it are apart.
        """
        special = self.encoder.model.special
        cut = [(at, text) for at, text in enumerate(texts) if any(token in text for token in special)]
        if not cut:
            return self.memory.joined(texts)
        found = dict(enumerate(self.memory.joined([text if not any(t in text for t in special) else "" for text in texts])))
        for at, text in cut:
            pieces = _around(text, special)
            words = iter(self.memory.joined([piece for piece in pieces if piece not in special]))
            parts = [(self.encoder.decimals[special[p]], self.encoder.decode([special[p]])) if p in special else next(words) for p in pieces]
            found[at] = tuple(b"".join(column) for column in zip(*parts, strict=True))
        return [found[at] for at in range(len(texts))]


def _around(text: str, special: dict[str, int]) -> list[str]:
    """``text`` in pieces: special tokens, leftmost and longest first, and what stands between them."""
    pieces, start = [], 0
    while True:
        hits = [(at, -len(token), token) for token in special if (at := text.find(token, start)) >= 0]
        if not hits:
            return [*pieces, text[start:]]
        at, _, token = min(hits)
        pieces += [text[start:at], token]
        start = at + len(token)


@functools.lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    """One for each Python worker; it lasts as long as Spark keeps the worker."""
    return Codec(path)


def encode(table: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL) -> DataFrame:
    """``id`` and ``ids`` (array of int) of every row; see ``round_trip``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in slices(batches):
            rows = [[int(x) for x in ids.split(b",")[:-1]] for ids, _ in own.round_trips(batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(rows, pa.list_(pa.int32()))], ["id", "ids"])

    return identified_texts(table, id_column, text_column).mapInArrow(run, "id long, ids array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``id`` and ``text`` of rows of ``id`` and ``ids``. Bytes that are no UTF-8 become U+FFFD.

    A null or empty list gives an empty text. An id outside the vocabulary is an error.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = codec(model).encoder
        for batch in batches:
            texts = [encoder.decode(ids or []).decode("utf-8", "replace") for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(texts, pa.string())], ["id", "text"])

    return encoded.select("id", "ids").mapInArrow(run, "id long, text string")


def round_trip(table: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL) -> DataFrame:
    """One row per row of ``table``: its id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    The first hash is that of the ids in decimals with commas between them, the second that of the decoded text in UTF-8.
    Each match of the public pattern is a word. A word that is a token is done. For the others the longest token from
    each place on is a guess; a guess is right if all of its neighbours stay apart, as ``Encoder.compatible`` finds for all
    pairs of a task's new words at once. Only words whose guess fails are merged. Any length of word and text takes
    memory in proportion.

    A null text counts as empty: no tokens, and the hashes of nothing. Repeated rows come back each. A null id stays null.
    An empty table gives no rows. Other columns are left out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in slices(batches):
            found = own.round_trips(batch["text"].to_pylist())
            columns = [
                pa.array([ids.count(b",") for ids, _ in found], pa.int64()),
                pa.array([hashlib.sha256(ids[:-1]).hexdigest() for ids, _ in found]),
                pa.array([hashlib.sha256(_text(decoded)).hexdigest() for _, decoded in found]),
            ]
            yield pa.RecordBatch.from_arrays([batch["id"], *columns], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return identified_texts(table, id_column, text_column).mapInArrow(run, schema).withColumnRenamed("id", id_column)


def _text(decoded: bytes) -> bytes:
    return decoded.decode("utf-8", "replace").encode()
