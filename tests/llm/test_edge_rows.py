"""Nulls, empty and long texts, repeated rows, empty tables and clashing extra columns, for every operator."""

import pytest

import corpus_pipeline
from slipway.llm.byte_bpe import round_trip
from slipway.llm.decontaminate import benchmark_passages, without_leaks
from slipway.llm.license_scan import license_scan
from slipway.llm.quality_model import quality_scores
from slipway.llm.quality_rules import kept_by_quality, quality_rules
from slipway.llm.secret_scan import secret_scan, without_secrets
from slipway.llm.simhash_dedup import near_duplicates, one_of_each
from slipway.llm.token_counts import token_counts
from slipway.llm.url_trust import url_verdicts
from slipway.llm.warc import warc_round_trip

# Names that the operators use within.
CLASHES = ["id", "word", "label", "fingerprint", "kept", "n_words", "_words", "block", "size", "value", "place", "host", "path", "rule", "row", "score", "node", "_gone", "_leak", "_row", "position", "refers_to", "votes", "q1", "places", "lines"]
LONG = " ".join(f"word{number % 997} of a long text" for number in range(40_000))


def documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ", ".join(f"{name} string" for name in CLASHES)
    return spark.createDataFrame([(*row, *(["x"] * len(CLASHES))) for row in rows], f"{schema}, {extra}")


ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, LONG, None, "a", len(LONG)),
    (4, "one two three four five six", "en", "a", 27),
    (4, "one two three four five six", "en", "a", 27),
    (None, "one two three four five six", None, None, 27),
    (5, " \n\t ", "de", "b", 4),
    (6, "password = abcdefgh12 é 漢字 MIT License", "de", "b", None),
]


def passages(docs):
    spark = docs.sparkSession
    items = [(1, "one two three four five six"), (2, None), (3, ""), (None, "one two three four five six"), (5, "five")]
    return benchmark_passages(docs, spark.createDataFrame([(*row, "x") for row in items], "item_id long, text string, id string"))


BY_ROW = {
    "token_counts": token_counts, "byte_bpe": round_trip, "secret_scan": secret_scan, "quality_rules": quality_rules,
    "license_scan": license_scan, "quality_model": quality_scores, "near_duplicates": near_duplicates,
}


@pytest.mark.parametrize("name", BY_ROW)
def test_a_row_for_each_row(spark, name):
    found = BY_ROW[name](documents(spark, ROWS))
    ids = sorted((row.doc_id for row in found.collect()), key=repr)
    assert ids == sorted((row[0] for row in ROWS), key=repr)


@pytest.mark.parametrize("name", [*BY_ROW, "passages"])
def test_empty_table(spark, name):
    empty = documents(spark, [])
    assert (passages(empty) if name == "passages" else BY_ROW[name](empty)).count() == 0


def test_values_of_edge_rows(spark):
    docs = documents(spark, ROWS)
    counts = {row.doc_id: row for row in token_counts(docs).collect()}
    assert counts[1].n_tokens == counts[2].n_tokens == 0 and counts[3].n_tokens > 100_000
    codes = {row.doc_id: row for row in round_trip(docs).collect()}
    assert codes[1] [1:] == codes[2][1:] and codes[1].n_tokens == 0
    rules = {row.doc_id: row for row in quality_rules(docs).collect()}
    assert rules[1].n_words == rules[5].n_words == 0 and rules[1].base_failed and not rules[1].kept
    assert rules[3].n_words == 200_000
    labels = {row.doc_id: row for row in license_scan(docs).collect()}
    assert (labels[6].base_labels, labels[6].n_base, labels[6].first_word, labels[6].score) == ("mit", 1, 4, 1.0)
    assert (labels[1].n_words, labels[1].n_base, labels[1].first_word, labels[1].labels) == (0, 0, None, "")
    same = {row.doc_id: row for row in near_duplicates(docs).collect()}
    assert same[1].component_id == same[2].component_id == same[5].component_id == 1
    assert same[1].fingerprint == "0" * 16
    assert same[None].component_id == same[4].component_id == 4
    scores = {row.doc_id: row for row in quality_scores(docs).collect()}
    assert scores[1].score == 0 and not scores[1].kept


def test_passages_of_edge_rows(spark):
    found = passages(documents(spark, ROWS)).collect()
    assert {(row.doc_id, row.item_id) for row in found} >= {(4, 1), (None, 1), (4, None), (4, 5)}
    assert all(row.similarity == 1 for row in found)
    assert not {2, 3} & {row.item_id for row in found}


def test_stages_on_edge_rows(spark):
    docs = documents(spark, ROWS)
    kept = kept_by_quality(docs)
    assert kept.columns == docs.columns
    assert {row.doc_id for row in one_of_each(docs).collect()} == {1, 3, 4, 6, None}
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert {row.doc_id for row in without_leaks(docs, items).collect()} == {1, 2, 3, 5, 6, None}
    marked = {row.doc_id: row for row in without_secrets(docs).collect()}
    assert marked[6].text == "[secret] é 漢字 MIT License" and marked[6].n_chars == 25
    assert marked[1].text is None and marked[4].text == ROWS[3][1]


def test_stages_on_an_empty_table(spark, folder):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def pages(spark, rows):
    extra = ", ".join(f"{name} string" for name in CLASHES)
    return spark.createDataFrame([(*row, *(["x"] * len(CLASHES))) for row in rows], f"page_id long, url string, html string, {extra}")


PAGES = [
    (1, "http://a/x\r\ny", "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"),
    (2, None, None), (3, "no host", ""), (None, "http://B.c", ""), (3, "no host", ""), (4, "http://É.x/é?q", "é" * 300_000),
]


def test_archives_of_edge_rows(spark):
    found = sorted(((row.page_id or 0, row.payload_bytes, row.record_type, row.refers_to) for row in warc_round_trip(pages(spark, PAGES)).collect()), key=repr)
    assert found == [
        (0, 0, "revisit", 3), (1, 38, "response", None), (2, 0, "revisit", 3), (3, 0, "response", None),
        (3, 0, "response", None), (4, 600_000, "response", None),
    ]
    assert warc_round_trip(pages(spark, [])).count() == 0


def test_urls_of_edge_rows(spark):
    found = {row.page_id: row for row in url_verdicts(pages(spark, PAGES)).collect()}
    assert (found[2].host, found[2].path, found[2].rule, found[2].verdict) == ("", "", None, "allow")
    assert found[3].host == "" and found[None].host == "b.c" and found[4].host == "É.x" and found[4].path == "/é"
    assert url_verdicts(pages(spark, PAGES)).count() == len(PAGES)
    assert url_verdicts(pages(spark, [])).count() == 0
