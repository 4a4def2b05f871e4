"""The adaptive bounds against a plain calculation from the values themselves."""

import random

from slipway.llm.quality_rules import (
    MEASURES, PRIOR, REACH, SKETCH_BITS, SLACK, UNIT, kept_by_quality, measured, quality_rules, sketches, thresholds,
)

COLUMNS = "lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def rounded(value):
    shift = max(value.bit_length() - SKETCH_BITS, 0)
    return value >> shift << shift


def values(row):
    _, _, words, chars, symbols, dups, repeats, lines = row
    if words < 50 or 100 * repeats > 50 * words:
        return {}
    return {"symbols": symbols * 1000 // words, "repeats": repeats * 1000 // words, "dup_lines": dups * 1000 // lines, "word_size": chars * 100 // words}


def counts_of(rows, name):
    counts = {}
    for row in rows:
        if name in (found := values(row)):
            counts[rounded(found[name])] = counts.get(rounded(found[name]), 0) + 1
    return counts


def shares(counts, wider):
    if wider is None:
        return {bucket: n * UNIT // sum(counts.values()) for bucket, n in counts.items()}
    return {bucket: mass // (sum(counts.values()) + PRIOR) for bucket, mass in blended(counts, wider).items()}


def blended(counts, wider):
    return {bucket: counts.get(bucket, 0) * UNIT + PRIOR * wider.get(bucket, 0) for bucket in counts.keys() | wider.keys()}


def quantile(masses, tail):
    upto = 0
    for bucket in sorted(masses):
        upto += masses[bucket]
        if upto * 1000 >= sum(masses.values()) * tail:
            return bucket


def test_bounds(spark):
    chance = random.Random(5)
    rows = []
    for lang, source, size in [("a", "x", 300), ("a", "y", 3), ("a", None, 40), (None, "x", 1), ("b", "x", 1)]:
        for _ in range(size):
            words = chance.randint(20, 900)
            rows.append((
                lang, source, words, words * chance.randint(3, 9), chance.choice([0, 0, 0, words // 3]),
                chance.randint(0, 2), chance.randint(0, words), chance.randint(3, 30),
            ))
    rows += [("a", "z", 60, 300, 0, 0, 0, 1), ("c", "x", 10, 50, 0, 0, 0, 1)]
    found = {(row.lang, row.source): row for row in thresholds(sketches(spark.createDataFrame(rows, COLUMNS).repartition(5))).collect()}
    assert ("c", "x") not in found  # all of its texts fail the fixed rules
    for (lang, source), row in found.items():
        group = [each for each in rows if each[:2] == (lang, source)]
        for name, tail in MEASURES.items():
            of_all = shares(counts_of(rows, name), None)
            of_lang = shares(counts_of([each for each in rows if each[0] == lang], name), of_all)
            masses = blended(counts_of(group, name), of_lang)
            top, middle, bottom = (quantile(masses, part) for part in (tail, 500, 1000 - tail))
            assert row[f"high_{name}"] == top + REACH * (top - middle) + SLACK
            assert row[f"low_{name}"] == bottom - REACH * (middle - bottom) - SLACK


def test_groups_differ_and_the_spread_decides(spark):
    """The same text is usual in one source and not in the other; the bound moves with the group's own spread."""
    wide = [("a", "code", 100, 500, n % 30, 0, 0, 1) for n in range(2000)]
    narrow = [("a", "news", 100, 500, 0, 0, 0, 1)] * 2000
    found = {row.source: row for row in thresholds(sketches(spark.createDataFrame(wide + narrow, COLUMNS))).collect()}
    assert found["news"].high_symbols == SLACK
    assert found["code"].high_symbols > 10 * SLACK


def test_labels(spark, table):
    """No text that is labelled good goes beyond what the fixed rules reject, and none labelled bad stays."""
    judged = quality_rules(table("documents")).join(table("labels"), "doc_id").collect()
    assert all(row.kept or row.base_failed for row in judged if row.quality == 1)
    assert not any(row.kept for row in judged if row.quality == 0)


def test_the_stage_keeps_what_the_operator_keeps(spark, table):
    docs = table("documents")
    kept = {row.doc_id for row in quality_rules(docs).where("kept").collect()}
    assert {row.doc_id for row in kept_by_quality(docs).collect()} == kept
    assert measured(docs).count() == docs.count()
