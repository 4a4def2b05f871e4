"""Words of many texts at once, as arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that each bit depends on all."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@dataclass
class Words:
    """Runs without ASCII white space of texts in which A-Z became a-z.

    ``data`` holds the texts' bytes with a line break after each. ``starts`` and ``ends`` are places in it, ``texts``
    the text that a word is from, ``hashes`` 64 bits each. Words ``first[i]`` to ``first[i + 1]`` are text ``i``'s,
    whose bytes begin at ``begins[i]``.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    texts: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        encoded = [text.encode().lower() for text in texts]
        begins = np.cumsum([0, *(len(text) + 1 for text in encoded)])
        data = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
        space = _SPACE[data]
        edges = np.flatnonzero(np.diff(space, prepend=True))
        starts, ends = edges[::2], edges[1::2]
        # The sum of byte * factor ** place over a word's places in the data, shifted to begin at 0.
        with np.errstate(over="ignore"):
            powers = np.full(len(data) + 1, _FACTOR, np.uint64)
            powers[:1] = 1
            powers = np.cumprod(powers)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
            back = np.full(len(data) + 1, _INVERSE, np.uint64)
            back[:1] = 1
            back = np.cumprod(back)
            hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
        first = np.searchsorted(starts, begins)
        owners = np.repeat(np.arange(len(texts)), np.diff(first))
        return cls(data, starts, ends, owners, hashes, first, begins)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash for every ``size`` words in a row within a text, and the place of its first word."""
        count = len(self.hashes) - size + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            total = np.zeros(count, np.uint64)
            for step in range(size):
                total = total * np.uint64(_FACTOR) + self.hashes[step : step + count]
            within = np.flatnonzero(self.texts[:count] == self.texts[size - 1 :])
            return mix(total[within]), within
