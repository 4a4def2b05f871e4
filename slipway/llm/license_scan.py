"""License notices: named licenses, and lines or runs of words that contain most of a notice's words."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slipway.llm.frames import identified_texts, stored

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A block meets a template if it has so large a part of the template's different words.
CONTAINMENT = 0.8
# Notices of so many different words or fewer must be there whole: any one word of theirs may be the telling one.
SHORT = 13

# The phrases that name a license, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices as their licenses give them, and their labels.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
    "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so",
    "apache": "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by "
    "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    "gpl-short": "This work is licensed under the GNU General Public License, version 3.",
    "mit-short": "Released under the MIT License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
}
# Words without which a long notice is another license's, and words that make a notice another license's.
TELLING = {"apache": ("apache",)}
UNLESS = {
    "cc-by": ("nc", "nd", "sa", "noncommercial", "noderivatives", "noderivs", "sharealike"),
    "cc-by-nc": ("nd", "sa", "noderivatives", "noderivs", "sharealike"),
}


def _lowered(text: Column) -> Column:
    """A-Z lowered. ``lower`` is quick and only differs for letters beyond ASCII, which are word characters before and
    after it, but for two, which would become ASCII and are taken out first."""
    plain = F.replace(F.replace(text, F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ı"))
    return F.lower(plain)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, NOT_WORD), "")


def _template_words(templates: Mapping[str, str]) -> list[tuple[str, list[str]]]:
    return [(name, [*dict.fromkeys(re.sub(NOT_WORD, " ", text.lower()).split())]) for name, text in templates.items()]


def _places(words: Column) -> Column:
    """Where a phrase begins in ``words``, as (start, label)."""

    def starts(phrase: str, label: str) -> Column:
        parts = phrase.split()

        def here(word: Column, at: Column) -> Column:
            found = word == parts[0]
            for step, part in enumerate(parts[1:], 1):
                found = found & F.coalesce(F.get(words, at + step) == part, F.lit(False))
            return F.when(found, F.struct(at.cast("long").alias("start"), F.lit(label).alias("label")))

        return F.filter(F.transform(words, here), lambda place: place.isNotNull())

    return F.concat(*(starts(phrase, label) for phrase, label in PHRASES.items()))


class _Notice(NamedTuple):
    """A template as blocks and runs are held against it."""

    template: str
    words: list[str]  # the different ones
    needed: int  # so many of them
    most: int  # words that a block or run may have
    telling: list[str]
    unless: list[str]


def _notices(templates: Mapping[str, str], least: float, whole: int, part: float) -> list[_Notice]:
    """Templates of ``whole`` different words or fewer need all of them, the others ``least``. A block may hold so many
    other words that the template makes up ``part`` of it: what a notice's writer put in, or comment signs."""
    found = []
    for name, words in _template_words(templates):
        needed = len(words) if len(words) <= whole else -(-round(len(words) * least * 1_000_000) // 1_000_000)
        length = len(re.sub(NOT_WORD, " ", templates[name].lower()).split())
        most = -(-round(length * 1_000_000) // round(part * 1_000_000)) if part else 2**31 - 1
        found.append(_Notice(name, words, needed, most, [*TELLING.get(name, ())], [*UNLESS.get(name, ())]))
    return found


def _texts(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)).cast("array<string>")


def _table(spark: SparkSession, rows: list[Column]) -> DataFrame:
    """A small table of literal structs."""
    return spark.range(1).select(F.inline(F.array(*rows)))


def _known(notices: list[_Notice]) -> list[str]:
    """All words that decide anything."""
    return sorted({word for notice in notices for word in (*notice.words, *notice.unless)})


def _no_matches(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.lit("").alias("template"), F.lit(0.0).alias("score")).limit(0)


def block_matches(
    blocks: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = CONTAINMENT, whole: int = 0, part: float = 0.0
) -> DataFrame:
    """``id``, ``template`` and ``score`` for every block (``id``, ``words``: array) that has ``least`` or more of a
    template's different words; the score is that part. Templates of ``whole`` words or fewer must be there whole. If
    ``part`` is given, blocks of which the template would make up less do not count. Words of ``TELLING`` must be
    there, those of ``UNLESS`` must not.

    Words are ordered by how many blocks have them, rarest first. A block that has all but ``k`` of a template's words
    has one of the first ``k + 1`` in this order (prefix filter), and has words enough, but not too many (length
    filter). At the first word that both have, what follows it in the template, and what follows it in the block, must
    suffice for the rest (positional filter). Only words of templates are counted and kept, of which there is a number
    fixed by the templates, so the first pass drops blocks that cannot match before any is spread over rows. Candidates
    are verified by their whole word sets.
    """
    spark = blocks.sparkSession
    notices = _notices(templates, least, whole, part)
    if not notices:
        return _no_matches(blocks)
    held = blocks.select("id", F.size("words").alias("n"), F.array_intersect("words", _texts(_known(notices))).alias("words"))
    held = stored(held.where(F.size("words") >= min(notice.needed for notice in notices)), "blocks")
    # One row for each word of the templates at most.
    counts = dict(held.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*")).collect())
    order = sorted(_known(notices), key=lambda word: (counts.get(word, 0), word))
    prefix = [
        F.struct(F.lit(notice.template).alias("template"), F.lit(word).alias("word"), F.lit(at).alias("at"))
        for notice in notices
        for at, word in enumerate(sorted(notice.words, key=order.index)[: len(notice.words) - notice.needed + 1])
    ]
    bounds = [
        F.struct(
            F.lit(notice.template).alias("template"), _texts(notice.words).alias("template_words"),
            F.lit(notice.needed).alias("needed"), F.lit(notice.most).alias("most"),
            _texts(notice.telling).alias("telling"), _texts(notice.unless).alias("unless"),
        )
        for notice in notices
    ]
    # An intersection has the order of its first array.
    tokens = held.select("id", "n", F.array_intersect(_texts(order), "words").alias("words"), F.monotonically_increasing_id().alias("block"))
    tokens = tokens.select("*", F.posexplode("words").alias("place", "word"))
    met = tokens.join(F.broadcast(_table(spark, prefix)), "word").join(F.broadcast(_table(spark, bounds)), "template")
    met = met.where("size(words) >= needed and n <= most").where(
        "1 + least(size(template_words) - at - 1, size(words) - place - 1) >= needed"
    )
    common = F.size(F.array_intersect("words", "template_words"))
    return (
        met.dropDuplicates(["block", "template"])
        .where(common >= F.col("needed"))
        .where(F.size(F.array_except("telling", "words")) == 0)
        .where(~F.arrays_overlap("unless", "words"))
        .select("id", "template", (common / F.size("template_words")).alias("score"))
    )


def run_matches(texts: DataFrame, templates: Mapping[str, str] = TEMPLATES, whole: int = 0) -> DataFrame:
    """``id``, ``template`` and ``score`` for every text (``id``, ``words``: array) with a run of words that has
    ``CONTAINMENT`` or more of a template's different words, or all of them if they are ``whole`` or fewer; the score is
    the largest part that one run has. The template makes up ``CONTAINMENT`` of the run; words of ``TELLING`` must be in
    it, those of ``UNLESS`` must not.

    Only the words that are the template's count, so a run ends at one of them and reaches back over as many words as
    it may have. A text is looked at for those templates of which it has enough words anywhere.
    """
    notices = _notices(templates, CONTAINMENT, whole, CONTAINMENT)
    if not notices:
        return _no_matches(texts)
    choices = F.array(*(
        F.struct(
            F.lit(notice.template).alias("name"), _texts(notice.words).alias("words"), F.lit(notice.needed).alias("needed"),
            F.lit(notice.most).alias("length"), _texts(notice.telling).alias("telling"), _texts(notice.unless).alias("unless"),
            _texts([*notice.words, *notice.unless]).alias("heeded"),
        )
        for notice in notices
    ))
    held = texts.select("id", "words", F.array_intersect("words", _texts(_known(notices))).alias("held"))
    near = F.filter(choices, lambda one: F.size(F.array_intersect("held", one["words"])) >= one["needed"])
    tried = held.select("id", "words", F.explode(near).alias("t"))
    hits = F.filter(
        F.transform("words", lambda word, at: F.struct(at.alias("at"), word.alias("word"))),
        lambda hit: F.array_contains(F.col("t.heeded"), hit["word"]),
    )
    tried = tried.select("id", "t", hits.alias("hits"))

    def counted(words: Column) -> Column:
        plain = F.size("t.telling") + F.size("t.unless") == 0
        other = (F.size(F.array_except("t.telling", words)) > 0) | F.arrays_overlap("t.unless", words)
        return F.when(plain, F.size(words)).when(other, F.lit(-1)).otherwise(F.size(words))

    def words_up_to(last: Column, at: Column) -> Column:
        start = F.greatest(at + 2 - F.col("t.length"), F.lit(1))
        run = F.filter(F.slice("hits", start, at + 2 - start), lambda hit: hit["at"] > last["at"] - F.col("t.length"))
        different = F.array_distinct(F.transform(run, lambda hit: hit["word"]))
        return F.get(F.transform(F.array(different), counted), F.lit(0))

    # A filter on the column itself would be worked out beside it, and its parts again for every hit.
    best = F.filter(F.array(F.array_max(F.transform("hits", words_up_to))), lambda best: best >= F.col("t.needed"))
    found = tried.select("id", "t", F.explode(best).alias("best"))
    return found.select("id", F.col("t.name").alias("template"), (F.col("best") / F.size("t.words")).alias("score"))


def license_scan(
    table: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: Mapping[str, str] = TEMPLATES
) -> DataFrame:
    """One row per row of ``table``: its id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels`` and ``score``.

    Base: the places where a phrase's words stand one after the other anywhere in the text. Blocks are a text's lines;
    ``block_matches`` finds those that contain a template, whose label is its name up to a hyphen but for ``cc-``.
    Notices that are wrapped over lines, or over paragraphs, or stand within a longer line, are found by ``run_matches``.
    Notices of ``SHORT`` different words or fewer count whole only.
    ``score`` is the largest containment, 1.0 where a phrase stands, else 0. Only texts with a word that all prefixes
    of some template need are cut into blocks. A null text counts as empty, with no words, no places and empty labels.
    Repeated rows come back each. An empty table gives no rows. Other columns are left out.
    """
    texts = identified_texts(table, id_column, text_column)
    lowered = texts.select("id", _lowered(F.col("text")).alias("text"))
    n_words = F.size(_words(F.col("text"))).cast("long")
    # Words are looked at one by one only in texts that name a license at all.
    empty = F.array().cast("array<struct<start: bigint, label: string>>")
    named = lowered.select(
        F.monotonically_increasing_id().alias("row"), "id", "text", n_words.alias("n_words"),
        F.when(F.contains("text", F.lit("license")), _words(F.col("text"))).alias("_words"),
    )
    scanned = named.withColumn("places", F.when(F.col("_words").isNotNull(), _places(F.col("_words"))).otherwise(empty))
    # A text without license words has no block that contains 0.8 of a notice; see _marks.
    lines = F.when(F.col("text").rlike(_marks(templates)), F.filter(F.split("text", "\n"), lambda line: line.rlike(_marks(templates))))
    notices = _notices(templates, CONTAINMENT, SHORT, CONTAINMENT)
    wrapped = F.when(F.col("text").rlike(_marks(templates)), _words(F.col("text")))
    fewest = min((notice.needed for notice in notices), default=0)
    wrapped = F.when(F.size(F.array_intersect(wrapped, _texts(_known(notices)))) >= fewest, wrapped)
    scanned = stored(scanned.select("row", "id", "n_words", "places", lines.alias("lines"), wrapped.alias("wrapped")), "scanned")
    blocks = scanned.where("lines is not null").select(F.col("row").alias("id"), F.explode("lines").alias("line"))
    blocks = blocks.select("id", _words(F.col("line")).alias("words"))
    matches = block_matches(blocks, templates, whole=SHORT, part=CONTAINMENT)
    runs = scanned.where("wrapped is not null").select(F.col("row").alias("id"), F.col("wrapped").alias("words"))
    matches = matches.union(run_matches(runs, templates, whole=SHORT))
    label = F.when(F.startswith("template", F.lit("cc-")), F.col("template")).otherwise(F.split_part("template", F.lit("-"), F.lit(1)))
    matches = matches.groupBy("id").agg(F.collect_set(label).alias("found"), F.max("score").alias("best"))
    matches = matches.withColumnRenamed("id", "_row")
    joined = scanned.drop("lines", "wrapped").join(matches, F.col("row") == F.col("_row"), "left")
    starts, labels = F.transform("places", lambda place: place["start"]), F.transform("places", lambda place: place["label"])
    every = F.array_union(labels, F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        F.col("id").alias(id_column),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _marks(templates: Mapping[str, str]) -> str:
    """A pattern that every block meeting a template matches.

    Of ``s`` words ``n`` must be there, so of any ``s - n + 1`` words at least one is. The longest words are the rarest
    in most texts, so this picks them; it decides what is read further, not what is found.
    """
    marks = set()
    for notice in _notices(templates, CONTAINMENT, SHORT, CONTAINMENT):
        longest = sorted(notice.words, key=lambda word: (-len(word), word))
        marks |= set(longest[: len(longest) - notice.needed + 1])
    return "|".join(sorted(marks)) or "(?!)"
