"""The cheapest cut of a value, held against a search that lists all pieces by itself."""

import math
import random

import pytest

from slipway.llm import secret_scan
from slipway.llm.secret_scan import COMMON_WORDS, find_secrets, guess_cost

ROWS = ["1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./"]
WRITTEN_FOR = {"4": "a", "@": "a", "3": "e", "1": "i", "0": "o", "$": "s", "5": "s", "!": "i", "7": "t"}


def way(a, b):
    spots = {key: (row, at) for row, keys in enumerate(ROWS) for at, key in enumerate(keys)}
    if a not in spots or b not in spots:
        return None
    down, right = spots[b][0] - spots[a][0], spots[b][1] - spots[a][1]
    return (down, right) if (down, right) in {(0, 1), (0, -1), (1, 0), (-1, 0), (1, -1), (-1, 1)} else None


def word_cost(piece):
    lower = piece.lower()
    plain = "".join(WRITTEN_FOR.get(letter, letter) for letter in lower)
    for written, extra in ((lower, 0), (plain, math.log10(4))):
        if written in COMMON_WORDS:
            big = sum(letter.isupper() for letter in piece)
            one = big == len(piece) or (big == 1 and piece[0].isupper())
            return math.log10(COMMON_WORDS.index(written) + 1) + extra + math.log10(2) * (min(big, 1) if one else big)
    return math.inf


def date_cost(piece):
    marks = [letter for letter in piece if not letter.isdigit()]
    if len(marks) not in (0, 2) or len(set(marks)) > 1 or not set(marks) <= set("-/._"):
        return math.inf
    digits = "".join(letter for letter in piece if letter.isdigit())
    if len(digits) == 4 and not marks:
        return math.log10(60) if digits[:2] in ("19", "20") else math.inf
    options = [(4, 2, 2, digits[:4], digits[4:6], digits[6:]), (2, 2, 4, digits[4:], digits[2:4], digits[:2])]
    for first, second, _, year, month, day in options:
        placed = not marks or [at for at, letter in enumerate(piece) if not letter.isdigit()] == [first, first + second + 1]
        if len(digits) == 8 and placed and year[:2] in ("19", "20") and 1 <= int(month) <= 12 and 1 <= int(day) <= 31:
            return math.log10(365 * 60 * (4 if marks else 1))
    return math.inf


def piece_cost(piece):
    found = [word_cost(piece) if len(piece) > 1 else math.inf, date_cost(piece)]
    if len(piece) > 2:
        if len(set(piece)) == 1:
            found.append(math.log10(94 * len(piece)))
        steps = [way(a, b) for a, b in zip(piece.lower(), piece.lower()[1:])]
        if None not in steps:
            turns = 1 + sum(a != b for a, b in zip(steps, steps[1:]))
            found.append(math.log10(sum(map(len, ROWS)) * len(piece)) + turns * math.log10(6))
    return min(found)


def cheapest(value):
    sizes = {"digit": 10, "low": 26, "up": 26, "other": 33}
    kinds = {
        "digit" if c in "0123456789" else "low" if "a" <= c <= "z" else "up" if "A" <= c <= "Z" else "other" for c in value
    }
    one = math.log10(sum(sizes[kind] for kind in kinds))
    best = [0.0]
    for end in range(1, len(value) + 1):
        pieces = [best[start] + piece_cost(value[start:end]) + 0.3 for start in range(end)]
        best.append(min([best[-1] + one, *pieces]))
    return best[-1]


PARTS = [
    "password", "Secret", "t0ken", "ddd", "ddddd", "qwer", "qwe", "asdf", "sdfds", "1qaz", "2019", "2019-01-31", "31.12.1999",
    "20200230", "12019", "a", "X", "7", "$", "é", "zz", "111", "19", "-", "the",
]


def test_against_every_cut():
    chance = random.Random(3)
    for _ in range(300):
        value = "".join(chance.choices(PARTS, k=chance.randint(1, 6)))
        assert guess_cost(value) == pytest.approx(cheapest(value)), value
        limit = chance.uniform(2, 14)
        assert (guess_cost(value, limit) >= limit) == (cheapest(value) >= limit - 1e-9), value


def test_parts_of_runs_count():
    assert guess_cost("passwordddddd") == pytest.approx(cheapest("password") + cheapest("ddddd"))
    assert find_secrets("pwd: 'mypasswordddddd'") == []
    assert guess_cost("12019-01-311") == pytest.approx(cheapest("12019-01-311"))


def test_long_runs_are_quick():
    for value in ("a" * 200_000, "as" * 20_000, "qwertyuiop" * 4_000, "passwordd" * 4_000, "1" * 1000 + "qaz" * 10_000):
        assert guess_cost(value) > 0
        assert guess_cost(value, 10) > 0
    assert guess_cost("asdsa" * 10_000, 10) == 10
    assert guess_cost("a" * 300_000, 10) < 10
    assert secret_scan.guess_cost("xK9$" * 50_000, 10) == 10
