"""Texts turned around for learning to fill in their middle, cut by an indexable skip list."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.frames import identified_texts, slices

# What marks the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Nodes of a lane that one node of the lane above spans.
FAN = 8

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class SkipList:
    """A text's tokens, to be found by rank. Each node of a lane knows how many tokens and code points it spans.

    The lowest lane has a node for each token, each lane above a node for ``FAN`` nodes below, up to a lane of one. A token
    is a run without white space together with the white space before it; white space at the end is one as well.
    """

    def __init__(self, text: str) -> None:
        data = np.frombuffer(text.encode(), np.uint8)
        space = _SPACE[data]
        ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        starts = np.concatenate([np.zeros(1, np.int64), ends]) if len(data) else np.zeros(0, np.int64)
        if len(data) == len(text) or not len(data):
            points = np.diff(starts, append=len(data))
        else:
            points = np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)
        self.lanes = [(np.ones(len(starts), np.int64), points)]
        while len(self.lanes[-1][0]) > 1:
            units, points = self.lanes[-1]
            heads = np.arange(0, len(units), FAN)
            self.lanes.append((np.add.reduceat(units, heads), np.add.reduceat(points, heads)))
        self.size = len(starts)

    def code_points(self, rank: int) -> int:
        """How many code points the first ``rank`` tokens have, found from the top lane down.

        On each lane the search goes on while the next node ends at or before the rank, and then one lane down.
        """
        at = passed = reached = 0
        for units, points in reversed(self.lanes):
            while at < len(units) and passed + units[at] <= rank:
                passed, reached, at = passed + int(units[at]), reached + int(points[at]), at + 1
            at *= FAN
        return reached


def arranged(number: int | None, text: str, seed: int, rate: int, suffix_first: int) -> tuple[int, str, str, int | None, int | None]:
    """Tokens, form, output, and the code points of prefix and middle."""
    digest = hashlib.sha256(f"{seed}:{'' if number is None else number}".encode()).hexdigest()
    first, second, third, fourth = (int(digest[at : at + 8], 16) for at in range(0, 32, 8))
    tokens = SkipList(text)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or third % 100 >= rate:
        return tokens.size, "plain", text, None, None
    cuts = sorted((first % (tokens.size + 1), second % (tokens.size + 1)))
    start, end = map(tokens.code_points, cuts)
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if fourth % 100 < suffix_first:
        return tokens.size, "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", start, end - start
    return tokens.size, "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", start, end - start


def fill_in_middle(
    table: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    seed: int = 42, rate: int = 50, suffix_first: int = 80,
) -> DataFrame:
    """One row per row of ``table``: ``id``, ``n``, ``form``, ``output``, ``prefix_chars`` and ``middle_chars``.

    ``n`` is the number of tokens. Two cuts, drawn by the hash of ``seed`` and id, part the text into prefix, middle and
    suffix at whole tokens. In form ``psm`` the output is prefix, suffix, middle, in ``spm`` suffix, prefix, middle, each
    after its mark. Of 100 texts ``rate`` are turned around, of these ``suffix_first`` as ``spm``. The others are ``plain``,
    with the text as output and no counts, and so are empty texts and those that hold a mark.

    A null text counts as empty. A null id stays null and is hashed as nothing after the seed. Repeated rows come back
    each, alike. An empty table gives no rows. Other columns are left out. Memory is that of the longest text a few times.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, texts = batch["id"].to_pylist(), batch["text"].to_pylist()
            rows = [arranged(number, text, seed, rate, suffix_first) for number, text in zip(ids, texts, strict=True)]
            columns = zip(*rows, strict=True)
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["id"], *arrays], ["id", "n", "form", "output", "prefix_chars", "middle_chars"])

    schema = "id long, n long, form string, output string, prefix_chars long, middle_chars long"
    return identified_texts(table, id_column, text_column).mapInArrow(run, schema)


def restored(form: str, output: str) -> F.Column:
    """The text that an output was made from, by the first place of each mark."""

    def between(start: str, end: str) -> str:
        return f"substring({output}, locate('{start}', {output}) + 3, locate('{end}', {output}) - locate('{start}', {output}) - 3)"

    middle = f"substring({output}, locate('{MIDDLE}', {output}) + 3)"
    return F.expr(
        f"case {form} when 'psm' then concat({between(PREFIX, SUFFIX)}, {middle}, {between(SUFFIX, MIDDLE)})"
        f" when 'spm' then concat({between(PREFIX, MIDDLE)}, {middle}, {between(SUFFIX, PREFIX)}) else {output} end"
    )


def fill_in_middle_digests(docs: DataFrame) -> DataFrame:
    """``fill_in_middle`` over documents, with hashes in place of the texts: of the output and of the text restored from it."""
    return fill_in_middle(docs).select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored("form", "output"), 256).alias("restored_sha256"),
    )


FILL_ORACLE = r"""
with hashed as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents
), drawn as (
  select doc_id, text,
    regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens,
    ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
    ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
  from hashed
), cut as (
  select *, len(tokens) as n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as c1,
    greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as c2,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50
      then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from drawn
), parts as (
  select doc_id, n, form, text, array_to_string(tokens[:c1], '') as prefix,
    array_to_string(tokens[c1 + 1:c2], '') as middle, array_to_string(tokens[c2 + 1:], '') as suffix
  from cut
)
select doc_id, n::bigint as n, form,
  case when form <> 'plain' then length(prefix) end::bigint as prefix_chars,
  case when form <> 'plain' then length(middle) end::bigint as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""
