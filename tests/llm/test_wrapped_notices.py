"""Notices wrapped over lines."""

import random
import textwrap

import pytest

from slipway.llm.license_scan import CONTAINMENT, TEMPLATES, license_scan, run_matches

LABELS = {"mit": "mit", "bsd": "bsd", "gpl": "gpl", "apache": "apache"}


def labels(spark, texts):
    found = license_scan(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()
    return {row.doc_id: (set(row.labels.split(",")), row.score) for row in found}


def test_wrapped_notices(spark):
    other = "Some prose that says nothing of the kind, in a line of its own."
    texts, expected = [], []
    for name, label in LABELS.items():
        for width, prefix in ((40, ""), (72, " * "), (20, "# ")):
            lines = textwrap.wrap(TEMPLATES[name], width)
            lines[1:1] = [""] if name == "apache" else []
            texts.append("\n".join([other, "", *(prefix + line for line in lines), "", other]))
            expected.append(label)
    found = labels(spark, [*texts, "\n".join([other] * 50)])
    for at, label in enumerate(expected):
        assert label in found[at][0] and found[at][1] >= CONTAINMENT, texts[at]
    assert found[len(texts)] == ({""}, 0.0)


def test_words_far_apart_are_no_notice(spark):
    words = TEMPLATES["bsd"].split()
    texts = ["\n".join(f"{word} x{n} y{n} z{n}" for n, word in enumerate(words))]
    assert labels(spark, texts)[0] == ({""}, 0.0)


def test_runs_against_every_window(spark):
    chance = random.Random(8)
    known = [f"w{n}" for n in range(14)]
    templates = {f"t{n}": " ".join(chance.choices(known, k=chance.randint(1, 9))) for n in range(7)}
    texts = [(n, chance.choices([*known, "x", "y"], k=chance.randint(0, 40))) for n in range(120)] + [(500, [])]
    found = {(row.id, row.template): row.score for row in run_matches(spark.createDataFrame(texts, "id long, words array<string>"), templates).collect()}
    expected = {}
    for key, words in texts:
        for name, text in templates.items():
            own = text.split()
            length = next(n for n in range(99) if n * CONTAINMENT >= len(own) - 1e-9)
            best = max((len(set(own) & set(words[at : at + length])) for at in range(len(words) or 1)), default=0)
            if best >= CONTAINMENT * len(set(own)) - 1e-9:
                expected[key, name] = best / len(set(own))
    assert found == pytest.approx(expected) and len(found) > 20
