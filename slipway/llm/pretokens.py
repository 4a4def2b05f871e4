"""Texts cut into the words that a byte-level vocabulary encodes one by one, and a memory of what words become."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import regex

# Letters and numerals that Unicode has gained since version 16, which the tokenizer libraries know.
NEWER = """
558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7
10ed9-10eee 11b0a 11db0-11ddb 11df1 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2
18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2
1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f
11de0-11de9 1246f 12475-1247f 12550-12686 16ff4-16ff6
"""
# Unicode's White_Space, which the public pattern's \s means; Python's own \s has four more.
_SPACE = r"\t-\r \x85\xa0  -     　"
_NEWER = "".join(
    "-".join(rf"\U{int(end, 16):08x}" for end in ends.split("-")) for ends in NEWER.split()
)

# Words of a text that are looked up at once, so that a long text takes no more than its own length.
PIECE = 250_000


def _pattern(letters: str, numerals: str, others: str, space: str) -> str:
    ends = "'(?:[stmd]|re|ve|ll)"
    return rf"{ends}| ?{letters}+| ?{numerals}+| ?{others}+|[{space}]+(?![^{space}])|[{space}]+"


_ASCII = re.compile(_pattern("[A-Za-z]", "[0-9]", r"[^\t-\r A-Za-z0-9]", r"\t-\r "))
_COMMON = regex.compile(_pattern(r"\p{L}", r"\p{N}", rf"[^{_SPACE}\p{{L}}\p{{N}}]", _SPACE))
_HAS_NEWER = re.compile(f"[{_NEWER}]")
_EXACT = regex.compile(
    _pattern(
        rf"(?:(?![{_NEWER}])\p{{L}})", rf"(?:(?![{_NEWER}])\p{{N}})",
        rf"(?:[^{_SPACE}\p{{L}}\p{{N}}]|[{_NEWER}])", _SPACE,
    )
)


def word_lists(text: str) -> Iterator[list[str]]:
    """The matches of the public pattern, which cover the whole text, in lists of at most ``PIECE``.

    The pattern is written in three ways that agree where each is used: for ASCII, for all of Unicode, and without the
    characters that the libraries do not know yet.
    """
    pattern = _ASCII if text.isascii() else _EXACT if not _latin(text) and _HAS_NEWER.search(text) else _COMMON
    if len(text) <= PIECE:
        yield pattern.findall(text)
    else:
        found = (match.group() for match in pattern.finditer(text))
        while words := [*itertools.islice(found, PIECE)]:
            yield words


def _latin(text: str) -> bool:
    """Quicker to tell than any search, and true of most texts."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Memory:
    """What a worker has worked out: for each word some strings of bytes.

    ``answer`` gives those of new words. Beyond ``most`` words only those that the texts at hand need are kept, so a
    worker's memory is bounded and an answer never depends on what came before.
    """

    def __init__(self, answer: Callable[[list[str]], list[tuple[bytes, ...]]], columns: int, most: int) -> None:
        self.answer, self.most = answer, most
        self.known: list[dict[str, bytes]] = [{} for _ in range(columns)]

    def joined(self, texts: list[str]) -> list[tuple[bytes, ...]]:
        """For each text, its words' answers joined in their order."""
        found: list[list[tuple[bytes, ...]]] = [[] for _ in texts]
        group: list[tuple[int, list[str]]] = []
        held = 0
        for at, text in enumerate(texts):
            for words in word_lists(text):
                group.append((at, words))
                held += len(words)
                if held >= PIECE:
                    self._join(group, found)
                    group, held = [], 0
        self._join(group, found)
        return [
            pieces[0] if len(pieces) == 1 else tuple(b"".join(column) for column in zip(*pieces, strict=True))
            if pieces else (b"",) * len(self.known)
            for pieces in found
        ]

    def _join(self, group: list[tuple[int, list[str]]], found: list[list[tuple[bytes, ...]]]) -> None:
        needed = set().union(*(words for _, words in group))
        new = needed.difference(self.known[0])
        if len(self.known[0]) + len(new) > self.most:
            kept = needed - new
            self.known = [{word: column[word] for word in kept} for column in self.known]
        if new:
            words = [*new]
            for column, values in zip(self.known, zip(*self.answer(words), strict=True), strict=True):
                column.update(zip(words, values, strict=True))
        for at, words in group:
            found[at].append(tuple(b"".join(map(column.__getitem__, words)) for column in self.known))
