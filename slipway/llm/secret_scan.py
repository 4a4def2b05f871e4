"""Secrets in texts: fixed patterns, and values in a credential's place that would take many guesses."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.frames import identified_texts, slices

# A value is reported from so many guesses on, as a power of ten.
LEAST_GUESSES = 10.0
LEAST_VALUE = 8


def _either_case(words: str) -> str:
    """The pattern with a class for each letter. Flags would also match other alphabets' letters."""
    return re.sub("[a-z]", lambda letter: f"[{letter[0]}{letter[0].upper()}]", words)


ASSIGN = re.compile(rf"""({_either_case("password|passwd|secret|token|api_?key")})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CONTEXT = re.compile(
    rf"""({_either_case("pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|(?:api|access|private|secret)[_-]?key")})"""
    r"""["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*["'`]?([^\s"'`<>,;]+)"""
)
# Texts without any of these need no search for assignments.
HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "key")
KINDS = ("assign", "access", "hex", "guess")

# Words that are tried first, the most common first.
COMMON_WORDS = """
password admin user root login guest test welcome secret default changeme letmein master qwerty dragon monkey football
baseball shadow sunshine princess iloveyou superman batman trustno hello freedom whatever ninja mustang access michael
jordan hunter ranger buster soccer hockey killer george charlie andrew daniel jessica pepper summer winter spring autumn
orange banana apple cookie cheese chocolate coffee flower purple yellow silver golden diamond phoenix thunder tigger
computer internet server database system service public private token key pass word example sample demo temp backup
company manager office account money love angel baby friend family house school secure security change please enter
the and for you with this that from have not are was but all one can out
""".split()
# The rows of a keyboard, each next one shifted to the right by half a key.
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
# Characters often written for letters.
LOOKS_LIKE = str.maketrans("4@310$5!7", "aaeiossit")

_RANKS = {word: rank for rank, word in reversed([*enumerate(COMMON_WORDS, 1)])}
_LONGEST = max(map(len, _RANKS))
_PLACES = {key: (row, place) for row, keys in enumerate(KEYBOARD) for place, key in enumerate(keys)}
# Dates and years, looked for at every place: those with a day that begin with the year, with the day, and years alone.
_DATES = tuple(
    re.compile(f"(?=({date}))")
    for date in (
        r"(?:19|20)\d\d(?P<mark>[-/._]?)(?:0[1-9]|1[0-2])(?P=mark)(?:0[1-9]|[12]\d|3[01])",
        r"(?:0[1-9]|[12]\d|3[01])(?P<mark>[-/._]?)(?:0[1-9]|1[0-2])(?P=mark)(?:19|20)\d\d",
        r"(?P<mark>)(?:19|20)\d\d",
    )
)
# What each piece but a character tried by itself costs more, and the least length of a repeat or walk.
_PIECE = 0.3
_LEAST_RUN = 3
_CLASSES = ((re.compile("[0-9]"), 10), (re.compile("[a-z]"), 26), (re.compile("[A-Z]"), 26), (re.compile("[^0-9A-Za-z]"), 33))


class Span(NamedTuple):
    """Where a secret stands, in code points, the end left out."""

    start: int
    kind: str
    end: int


def _word_cost(written: str) -> float | None:
    lower = written.lower()
    rank = _RANKS.get(lower)
    looked = 0.0
    if rank is None and (rank := _RANKS.get(lower.translate(LOOKS_LIKE))):
        looked = math.log10(4)
    if rank is None:
        return None
    upper = sum(map(str.isupper, written))
    cased = 0.0 if not upper else math.log10(2) if upper == len(written) or written[0].isupper() and upper == 1 else math.log10(2) * upper
    return math.log10(rank) + looked + cased


def _beside(a: str, b: str) -> int | None:
    """A number for the direction from one key to one next to it, or none."""
    if a not in _PLACES or b not in _PLACES:
        return None
    (row, place), (other_row, other_place) = _PLACES[a], _PLACES[b]
    step = (other_row - row, other_place - place)
    steps = ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1))
    return steps.index(step) if step in steps else None


def _dates(value: str) -> Iterator[tuple[int, int, float]]:
    """Start, end and cost of every date and year."""
    for pattern in _DATES:
        for found in pattern.finditer(value):
            days = 1.0 if len(found[1]) == 4 else 365.0
            yield *found.span(1), math.log10(days * 60 * (4 if found["mark"] else 1))


class _Starts:
    """The cheapest start of a repeat or walk that ends at a place, out of all starts within one longest run.

    A piece from ``start`` to ``end`` costs what ``add`` was given for the start, and log10 of its length. The part for
    the length grows ever more slowly, so a start that an earlier one has once undercut stays undercut; a later start
    that costs no more undercuts all before it. Only starts that neither is true of are looked at again.
    """

    def __init__(self) -> None:
        self._kept: list[tuple[int, float]] = []

    def add(self, start: int, cost: float) -> None:
        while self._kept and self._kept[-1][1] >= cost:
            self._kept.pop()
        self._kept.append((start, cost))

    def cheapest(self, end: int) -> float:
        kept: list[tuple[int, float]] = []
        least = math.inf
        for start, cost in self._kept:
            whole = cost + math.log10(end - start)
            if whole < least:
                kept.append((start, cost))
                least = whole
        self._kept = kept
        return least


def guess_cost(value: str, enough: float = math.inf) -> float:
    """The power of ten of the guesses that ``value`` takes: the cheapest way to cut it into common words, dates,
    repeats, keyboard walks and characters tried one by one, whose powers add up.

    ``best`` holds the cheapest cut of every prefix; each place looks back at all pieces that end there. Repeats of a
    character and walks count from every start to every end that are three or more apart; see ``_Starts`` for why that
    takes no square of a long run. Once all prefixes that a later piece could follow cost ``enough``, that is returned:
    no cut of the rest is cheaper than nothing.
    """
    lower = value.lower()
    # str.lower may lengthen a few letters, none of which is on a keyboard or equal to its neighbour in another way.
    keys = lower if len(lower) == len(value) else value
    ending: dict[int, list[tuple[int, float]]] = {}
    reach = [*range(1, len(value) + 1)]  # up to where a date that starts here may end
    for start, end, cost in _dates(value):
        ending.setdefault(end, []).append((start, cost))
        reach[start] = max(reach[start], end)
    pool = math.log10(sum(size for kind, size in _CLASSES if kind.search(value)) or 1)
    turn = math.log10(6)
    best = [0.0]
    furthest = 0
    below = 0  # the last prefix that costs less than enough
    repeat, repeat_from, walk, walk_from = _Starts(), 0, _Starts(), 0
    turns = [0]  # for each character, how often the walk up to the step after it has turned
    last: int | None = None
    for end in range(1, len(value) + 1):
        at = end - 1
        furthest = max(furthest, reach[at])
        if at and value[at] != value[at - 1]:
            repeat, repeat_from = _Starts(), at
        if at:
            way = _beside(keys[at - 1], keys[at])
            if way is None:
                walk, walk_from = _Starts(), at
            turns[at - 1] += way is not None and last is not None and way != last
            turns.append(turns[at - 1])
            last = way
        cost = best[-1] + pool
        for start in range(max(0, end - _LONGEST), end - 1):
            if (word := _word_cost(value[start:end])) is not None:
                cost = min(cost, best[start] + word + _PIECE)
        for start, piece in ending.get(end, ()):
            cost = min(cost, best[start] + piece + _PIECE)
        start = end - _LEAST_RUN
        if start >= repeat_from:
            repeat.add(start, best[start])
            cost = min(cost, repeat.cheapest(end) + math.log10(94) + _PIECE)
        if start >= walk_from:
            walk.add(start, best[start] - turns[start] * turn)
            way_there = walk.cheapest(end) + (turns[end - 2] + 1) * turn
            cost = min(cost, way_there + math.log10(len(_PLACES)) + _PIECE)
        best.append(cost)
        # Inside a run, a later piece may start anywhere in it.
        if cost < enough:
            below = end
        if furthest <= end and below < min(end - _LONGEST + 1, repeat_from, walk_from):
            return enough
    return best[-1]


def find_secrets(text: str, least: float = LEAST_GUESSES) -> list[Span]:
    """All spans by start, then kind in the order of ``KINDS``.

    Base spans: ``assign`` (a whole assignment whose value has 8 characters or more), ``access`` (16 or more) and
    ``hex`` (32 or more), each leftmost and without overlap within its kind. Further spans, ``guess``: values in a
    credential's place that overlap no base span, have 8 characters or more and take 10 ** ``least`` guesses.
    """
    found = [Span(match.start(), "hex", match.end()) for match in HEX.finditer(text)]
    if "AKIA" in text:
        found += [Span(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    lower = text.lower()
    if any(hint in lower for hint in HINTS):
        found += [Span(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
        base = sorted((span.start, span.end) for span in found)
        taken = 0
        for match in CONTEXT.finditer(text):
            start, end = match.span(2)
            while taken < len(base) and base[taken][1] <= start:
                taken += 1
            free = taken == len(base) or base[taken][0] >= end
            if free and end - start >= LEAST_VALUE and guess_cost(text[start:end], least) >= least:
                found.append(Span(start, "guess", end))
    return sorted(found, key=lambda span: (span.start, KINDS.index(span.kind)))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{span.kind}:{span.start}:{span.end}" for span in spans)


def secret_scan(table: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``table``: its id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``.

    Spans are written ``kind:start:end``, comma-joined; ``base_sha256`` hashes those of the base alone. Whole texts are
    searched, row by row, without a shuffle. A null text counts as empty. Repeated rows come back each, a null id stays
    null, an empty table gives no rows, other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch["text"].to_pylist():
                spans = find_secrets(text)
                base = [span for span in spans if span.kind != "guess"]
                counts = [sum(span.kind == kind for span in base) for kind in KINDS[:3]]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            yield pa.RecordBatch.from_arrays([batch["id"], *map(pa.array, zip(*rows, strict=True))], names)

    names = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    schema = "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    found = identified_texts(table, id_column, text_column).mapInArrow(run, schema)
    return found.withColumnRenamed("id", id_column)


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with ``mark`` in the place of every stretch that spans cover."""
    if not text or not (spans := find_secrets(text)):
        return text
    parts, done = [], 0
    for start, _, end in spans:
        if start > done or not parts:
            parts += [text[done:start], mark]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def without_secrets(table: DataFrame, text_column: str = "text", size_column: str = "n_chars") -> DataFrame:
    """``table`` with secrets in ``text_column`` marked as such and ``size_column`` counted anew. All rows stay."""

    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        return texts.map(redact, na_action="ignore")

    changed = table.withColumn(text_column, redacted(F.col(text_column)))
    return changed.withColumn(size_column, F.length(text_column).cast("long"))
