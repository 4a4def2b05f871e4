"""Byte-level BPE by recursive queries, one embedded database per task."""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from slipway.llm.frames import identified_texts, slices
from slipway.llm.pretokens import Memory

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Words that a Python worker remembers.
MOST_KNOWN = 400_000
# Words beyond so many bytes are contracted by a heap: the recursive query keeps the rows of every step, whose number
# grows with the square of a word's length.
LONG_WORD = 128
# Bytes of words, and tokens, that one query is asked about; shorter words' steps take some 256 bytes a byte at most.
ASKED = 1 << 18

# Each word's rows of position and token join the merge table; the least rank, and of these the leftmost, contracts.
# Words without a pair left are done.
ENCODE = """
with recursive parts as (
  select word, tokens, true as live from pieces
  union all
  select word,
    case when best is null then tokens
    else tokens[:(best & 4294967295) - 1] || [(best >> 32)::int] || tokens[(best & 4294967295) + 2:] end,
    best is not null
  from (select word, tokens from parts where live) left join (
    select word, min((rank::bigint << 32) | place) as best
    from (
      select word, unnest(tokens) as l, unnest(tokens[2:]) as r, unnest(range(1, len(tokens) + 1)) as place
      from parts where live
    ) join merges using (l, r)
    group by word
  ) using (word)
)
select word, tokens from parts where not live
"""

DECODE = """
select word, unhex(string_agg(hex(bytes), '' order by place)) as bytes
from (select word, unnest(tokens) as token, unnest(range(1, len(tokens) + 1)) as place from pieces)
join vocabulary using (token)
group by word
"""


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@dataclass
class Codec:
    """A vocabulary in an embedded database, with what it has encoded so far."""

    ranks: dict[bytes, int]

    def __post_init__(self) -> None:
        # Tables of one task are small; one thread, as Spark runs one task per core.
        self.database = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        splits = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for at in range(1, len(token))
            if (left := self.ranks.get(token[:at])) is not None and (right := self.ranks.get(token[at:])) is not None
        ]
        left, right, rank = (np.array(column, np.int32) for column in zip(*splits, strict=True))
        self._table("merges", pa.table({"l": left, "r": right, "rank": rank}))
        tokens = pa.table({"token": pa.array(self.ranks.values(), pa.int32()), "bytes": pa.array(self.ranks.keys(), pa.binary())})
        self._table("vocabulary", tokens)
        self.bytes = np.array([self.ranks[bytes([value])] for value in range(256)], np.int32)
        self.memory = Memory(self._answers, 2, MOST_KNOWN)

    def _table(self, name: str, rows: pa.Table) -> None:
        self.database.register("given", rows)
        self.database.execute(f"create table {name} as select * from given")
        self.database.unregister("given")

    def _ask(self, query: str, lists: pa.ListArray) -> tuple[list[int], pa.Array]:
        self.database.register("pieces", pa.table({"word": np.arange(len(lists)), "tokens": lists}))
        found = self.database.sql(query).to_arrow_table().combine_chunks()
        return found.column(0).to_pylist(), found.column(1)

    def merged(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        ids = {word: self.ranks[word].to_bytes(4, "little") for word in words if word in self.ranks}
        rest = [word for word in words if word and word not in ids]
        for some in _groups([word for word in rest if len(word) <= LONG_WORD]):
            ends = np.cumsum([0, *map(len, some)])
            tokens = self.bytes[np.frombuffer(b"".join(some), np.uint8)]
            places, lists = self._ask(ENCODE, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens))
            values = _list_bytes(lists)
            ids |= {some[place]: value for place, value in zip(places, values, strict=True)}
        return ids | {word: self.contracted(word) for word in rest if len(word) > LONG_WORD}

    def contracted(self, word: bytes) -> bytes:
        """The ids of one word: again and again the pair of the least rank, and of these the leftmost, contracts.

        A heap holds the pairs by rank, start and end; those whose tokens have changed since are passed over. It takes
        memory in proportion to the word.
        """
        size, ranks = len(word), self.ranks
        # Tokens by their first byte: where the next one begins, and the one before.
        after, before = array("q", range(1, size + 1)), array("q", range(-1, size - 1))
        live = bytearray(b"\1") * size
        heap = [rank << 80 | at << 40 | at + 2 for at in range(size - 1) if (rank := ranks.get(word[at : at + 2])) is not None]
        heapq.heapify(heap)
        mask = (1 << 40) - 1
        while heap:
            pair = heapq.heappop(heap)
            at, end = pair >> 40 & mask, pair & mask
            if not live[at] or (middle := after[at]) >= size or after[middle] != end:
                continue
            live[middle], after[at] = 0, end
            if end < size:
                before[end] = at
                if (rank := ranks.get(word[at : after[end]])) is not None:
                    heapq.heappush(heap, rank << 80 | at << 40 | after[end])
            if at > 0 and (rank := ranks.get(word[before[at] : end])) is not None:
                heapq.heappush(heap, rank << 80 | before[at] << 40 | end)
        starts = np.flatnonzero(np.frombuffer(live, np.uint8)).tolist()
        return np.array([ranks[word[at : after[at]]] for at in starts], "<u4").tobytes()

    def unmerged(self, sequences: list[bytes]) -> dict[bytes, bytes]:
        """The bytes that each sequence of ids stands for."""
        parts = [(at, ids[start : start + 4 * ASKED]) for at, ids in enumerate(sequences) for start in range(0, len(ids), 4 * ASKED)]
        back: dict[int, list[bytes]] = {}
        for some in _groups(parts, lambda part: len(part[1]) // 4):
            ends = np.cumsum([0, *(len(ids) // 4 for _, ids in some)])
            tokens = np.frombuffer(b"".join(ids for _, ids in some), "<u4").astype(np.int32)
            places, found = self._ask(DECODE, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens))
            for place, value in sorted(zip(places, found.to_pylist(), strict=True)):
                back.setdefault(some[place][0], []).append(value)
        return {b"": b""} | {sequences[at]: b"".join(values) for at, values in back.items()}

    def _answers(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        merged = self.merged([word.encode() for word in words])
        decoded = self.unmerged([*merged.values()])
        ids = [merged[word.encode()] for word in words]
        return [(value, decoded[value]) for value in ids]

    def round_trips(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids, as little-endian unsigned 32-bit integers, and the bytes that these stand for."""
        return self.memory.joined(texts)


def _groups(items: list, size: Callable[[Any], int] = len, most: int = ASKED) -> Iterator[list]:
    """The items in order, in groups of at most ``most`` in size, or of one."""
    group, held = [], 0
    for item in items:
        own = size(item)
        if group and held + own > most:
            yield group
            group, held = [], 0
        group.append(item)
        held += own
    if group:
        yield group


def _list_bytes(lists: pa.ListArray | pa.ChunkedArray) -> list[bytes]:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()) * 4
    data = lists.flatten().to_numpy().astype("<u4").tobytes()
    return [data[start:end] for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


@functools.lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    """One for each Python worker; it lasts as long as Spark keeps the worker."""
    return Codec(read_ranks(path))


def _mapped(table: DataFrame, path: str, row: Callable[[bytes, bytes], tuple], schema: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, names = codec(path), [field.split()[0] for field in schema.split(",")]
        for batch in slices(batches):
            columns = zip(*(row(*found) for found in own.round_trips(batch["text"].to_pylist())), strict=True)
            yield pa.RecordBatch.from_arrays([batch["id"], *map(pa.array, columns)], names)

    return table.mapInArrow(run, schema)


def encode(table: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranks: str = RANKS) -> DataFrame:
    """``id`` and ``ids`` (array of int) of every row, without special tokens; see ``round_trip``."""

    def row(ids: bytes, decoded: bytes) -> tuple[np.ndarray]:
        return (np.frombuffer(ids, "<u4").astype(np.int32),)

    return _mapped(identified_texts(table, id_column, text_column), ranks, row, "id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``id`` and ``bytes`` of rows of ``id`` and ``ids``, each row's tokens put together in their order.

    A null or empty list gives no bytes. An id outside the vocabulary is an error.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks)
        known = set(own.ranks.values())
        for batch in batches:
            rows = [np.array(ids or [], "<u4") for ids in batch["ids"].to_pylist()]
            if strange := {int(token) for ids in rows for token in ids} - known:
                raise ValueError(f"no such tokens: {sorted(strange)[:5]}")
            sequences = [ids.tobytes() for ids in rows]
            found = own.unmerged([*set(sequences) - {b""}])
            decoded = pa.array([found[ids] for ids in sequences], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["id"], decoded], ["id", "bytes"])

    return encoded.select("id", "ids").mapInArrow(run, "id long, bytes binary")


def round_trip(table: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranks: str = RANKS) -> DataFrame:
    """One row per row of ``table``: its id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    Each match of the public pattern is a word. Words that are tokens are done; the rest are contracted by the recursive
    query, or beyond ``LONG_WORD`` bytes by a heap. A task asks it about the words that are new to its worker, some thousands of documents' at a time, and puts
    the answers together per document, whatever the document's length. Decoding goes from ids to bytes alone.

    A null text counts as empty: no tokens, and the hashes of no bytes. Repeated rows come back each. A null id stays
    null. An empty table gives no rows. Other columns are left out.
    """

    def row(ids: bytes, decoded: bytes) -> tuple[int, str, str]:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    found = _mapped(identified_texts(table, id_column, text_column), ranks, row, schema)
    return found.withColumnRenamed("id", id_column)
