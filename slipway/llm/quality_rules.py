"""Quality rules whose thresholds adapt to each language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.llm.frames import stored

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]+"

# What is measured of a text, as whole numbers, and the quantile, per mille, at which its tail begins. Up to 150 texts of
# 1,000 in a group may be full of symbols before they move that bound; the other measures have long honest tails.
MEASURES = {"symbols": 850, "repeats": 990, "dup_lines": 990, "word_size": 900}
# A text may lie beyond its group's tail by so many times the way from the median to the tail, and by SLACK at least:
# 2 per cent of words or lines, or a fifth of a character a word, for groups without any spread.
REACH = 4
SLACK = 20
# A group's sketch is blended with its language's as if so many more of its texts were like those of the language, and
# the language's with that of all texts. So groups of every size are judged alike, and large ones by themselves.
PRIOR = 100
# Blended counts are whole numbers, in millionths of a text.
UNIT = 1_000_000
# A sketch keeps the leading bits of a value, so that quantiles are within 1/32 of it.
SKETCH_BITS = 6


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _windows(hashes: Column) -> Column:
    """A hash for each three words in a row."""
    starts = F.sequence(F.lit(0), F.size(hashes) - 3)
    windows = F.transform(starts, lambda at: F.xxhash64(hashes[at], hashes[at + 1], hashes[at + 2]))
    return F.when(F.size(hashes) >= 3, windows).otherwise(F.array().cast("array<long>"))


def _repeat_words(windows: Column) -> Column:
    """Words in windows that occur twice or more.

    Where hashes repeat, they are sorted with their places; neighbours of one hash are the repeated ones. Each such
    place then covers three words, or as many as the next such place leaves.
    """
    ordered = F.sort_array(F.transform(windows, lambda window, at: F.struct(window.alias("h"), at.alias("at"))))

    def places(windows: Column) -> Column:
        def repeated(window: Column, at: Column) -> Column:
            return ((at > 0) & (F.get(windows, at - 1)["h"] == window["h"])) | (
                F.coalesce(F.get(windows, at + 1)["h"] == window["h"], F.lit(False))
            )

        return F.sort_array(F.transform(F.filter(windows, repeated), lambda window: window["at"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda place, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - place, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    # A one-element array binds a value, so that it is worked out once.
    found = F.transform(F.transform(F.array(ordered), places), covered)[0]
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(found)


def measured(table: DataFrame, text_column: str = "text") -> DataFrame:
    """``table`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` added, and
    ``n_lines``, the lines with a word. All are column expressions over the whole text; null counts as no words."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    with_arrays = table.withColumns({"_words": _words(text), "_lines": lines})
    with_arrays = with_arrays.withColumns(
        {"_words": F.transform("_words", lambda word: F.xxhash64(word)), "_chars": F.length(F.array_join("_words", ""))}
    )
    with_arrays = with_arrays.withColumn("_windows", _windows(F.col("_words")))
    return with_arrays.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.col("_chars").cast("long"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("_windows")),
            "n_lines": F.size("_lines").cast("long"),
        }
    ).drop("_words", "_lines", "_windows", "_chars")


def _measures() -> dict[str, Column]:
    """Whole numbers, so that every engine gets the same; null where a text has no words."""
    words, lines = F.nullif(F.col("n_words"), F.lit(0)), F.nullif(F.col("n_lines"), F.lit(0))
    return {
        "symbols": F.floor(F.col("n_symbols") * 1000 / words),
        "repeats": F.floor(F.col("n_repeat_words") * 1000 / words),
        "dup_lines": F.floor(F.col("n_dup_lines") * 1000 / lines),
        "word_size": F.floor(F.col("word_chars") * 100 / words),
    }


def _bucket(value: Column) -> Column:
    """The value without all but its leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(rows: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``measure``, ``bucket`` and ``n``: per group and measure how many texts fall in a bucket.

    Texts that fail the fixed rules are left out, as they are judged already. Sketches merge by adding counts, whatever
    their order, so parts are added up before the shuffle, a language's sketch is the sum of its sources', and equal
    input gives equal thresholds. Their size depends on the number of groups, not of texts.
    """
    entries = [
        F.struct(F.lit(name).alias("measure"), F.when(~_failed(), value).cast("long").alias("value"))
        for name, value in _measures().items()
    ]
    return (
        rows.select("lang", "source", F.inline(F.array(*entries)))
        .where("value is not null")
        .groupBy("lang", "source", "measure", _bucket(F.col("value")).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def _shares(sketch: DataFrame, keys: list[str], wider: DataFrame | None) -> DataFrame:
    """``mass`` (texts) and ``share`` (part of the key's texts) of each bucket, both in millionths, for each of ``keys``.

    The shares of ``wider``, which has all but the last of ``keys``, count as ``PRIOR`` texts of each key.
    """
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    parts = merged.select(*keys, "measure", "bucket", "n", (F.col("n") * UNIT).alias("mass"))
    if wider is not None:
        each = merged.select(*keys, "measure").distinct().alias("e")
        same = F.expr(" and ".join(f"e.{key} <=> w.{key}" for key in (*keys[:-1], "measure")))
        likened = each.join(wider.alias("w"), same).select(
            *(f"e.{key}" for key in keys), "e.measure", "w.bucket", F.lit(0).cast("long").alias("n"), (F.col("w.share") * PRIOR).alias("mass")
        )
        parts = parts.union(likened).groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"))
    added = 0 if wider is None else PRIOR
    by = ", ".join((*keys, "measure"))
    return parts.selectExpr(*keys, "measure", "bucket", "mass", f"mass div (sum(n) over (partition by {by}) + {added}) as share")


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per ``lang`` and ``source`` with ``low_<measure>`` and ``high_<measure>``.

    The high bound is the tail quantile of the group's blended sketch, and ``REACH`` times the way from the median to
    it and ``SLACK`` beyond; the low bound is its mirror. A quantile is the least bucket that so many texts lie at or
    below. Windows hold the buckets of one key, of which there are some hundreds at most.
    """
    sketch = stored(sketch, "sketch")
    of_all = _shares(sketch, [], None)
    of_lang = _shares(sketch, ["lang"], of_all)
    own = _shares(sketch, ["lang", "source"], of_lang)
    counted = own.selectExpr(
        "*",
        "sum(mass) over (partition by lang, source, measure order by bucket) as upto",
        "sum(mass) over (partition by lang, source, measure) as size",
    )

    def quantile(tail: Column) -> Column:
        # size * tail / 1000, rounded up, without passing 64 bits
        needed = F.expr("size div 1000") * tail + F.floor((F.expr("size % 1000") * tail + 999) / 1000)
        return F.min(F.when(F.col("upto") >= needed, F.col("bucket")))

    tail = F.element_at(F.create_map(*(F.lit(x) for item in MEASURES.items() for x in item)), F.col("measure")).cast("long")
    found = counted.withColumn("tail", tail).groupBy("lang", "source", "measure").agg(
        quantile(F.col("tail")).alias("top"), quantile(F.lit(500)).alias("middle"), quantile(1000 - F.col("tail")).alias("bottom")
    )
    found = found.withColumns(
        {
            "high": F.col("top") + REACH * (F.col("top") - F.col("middle")) + SLACK,
            "low": F.col("bottom") - REACH * (F.col("middle") - F.col("bottom")) - SLACK,
        }
    )
    return found.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{side}_{name}") for name in MEASURES for side in ("low", "high"))
    )


def _failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` with ``base_failed`` and ``kept``. One row of ``limits`` at most fits a row."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(limits, F.expr("lang <=> _lang and source <=> _source"), "left")
    within = F.lit(True)
    for name, value in _measures().items():
        within = within & F.coalesce((value >= F.col(f"low_{name}")) & (value <= F.col(f"high_{name}")), F.lit(True))
    kept = ~F.col("base_failed") & within
    return joined.withColumn("base_failed", _failed()).withColumn("kept", kept).drop(*limits.columns)


def quality_rules(table: DataFrame) -> DataFrame:
    """One row per row of ``table`` (``doc_id``, ``text``, ``lang``, ``source``): ``doc_id``, ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` and ``kept``.

    ``kept`` is false if ``base_failed``, or if a measure lies outside its group's thresholds. The texts are read once;
    their counts are stored, sketched and judged. A null text has no words and fails. Null languages and sources are
    groups of their own. Repeated rows come back each; an empty table gives no rows; other columns are left out.
    """
    counts = stored(measured(table.select("doc_id", "text", "lang", "source")).drop("text"), "counts")
    judged = _judged(counts, thresholds(sketches(counts)))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def kept_by_quality(table: DataFrame) -> DataFrame:
    """The rows of ``table`` that ``quality_rules`` keeps, with their own columns.

    The texts are measured twice, once for the thresholds and once to be judged, so that none is shuffled. The row
    number keeps the filter above the counts; below them, it would hold the counting itself, many times over.
    """
    own = table.columns
    limits = stored(thresholds(sketches(measured(table.select("text", "lang", "source")))), "thresholds")
    keyed = table.select(F.struct(*(table[name] for name in own)).alias("_row"), "text", "lang", "source")
    judged = _judged(measured(keyed).withColumn("_number", F.monotonically_increasing_id()), limits)
    return judged.where("kept and _number >= 0").select("_row.*")


QUALITY_ORACLE = rf"""
with texts as (
  select doc_id, lang, source, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents
),
windows as (
  select row_number() over () as r, * from texts
),
spots as (
  select r, unnest(list_zip(words, words[2:], words[3:])) as w, unnest(range(1, len(words) + 1)) as p, len(words) as size from windows
),
marked as (
  select r, p, count(*) over (partition by r, w) as n from spots where p <= size - 2
),
covered as (
  select r, count(distinct w) as n_repeat_words from (select r, unnest([p, p + 1, p + 2]) as w from marked where n > 1) group by r
),
counts as (
  select doc_id, lang, source, len(words)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    len(lines)::bigint as n_lines
  from windows left join covered using (r)
),
valued as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as failed, case when n_words > 0 then [
    {{'m': 'symbols', 'v': n_symbols * 1000 // n_words, 't': {MEASURES["symbols"]}}}, {{'m': 'repeats', 'v': n_repeat_words * 1000 // n_words, 't': {MEASURES["repeats"]}}},
    {{'m': 'dup_lines', 'v': n_dup_lines * 1000 // n_lines, 't': {MEASURES["dup_lines"]}}}, {{'m': 'word_size', 'v': word_chars * 100 // n_words, 't': {MEASURES["word_size"]}}}
  ] else [] end as vs, row_number() over () as k
  from counts
),
long as (select k, lang, source, failed, unnest(vs, recursive := true) from valued),
buckets as (
  select lang, source, m, t, (v >> greatest(length(bin(v)) - {SKETCH_BITS}, 0)) << greatest(length(bin(v)) - {SKETCH_BITS}, 0) as b, count(*) as n
  from long where not failed group by all
),
of_all as (select m, b, sum(n) * {UNIT} // sum(sum(n)) over (partition by m) as share from buckets group by m, b),
of_lang as (
  select lang, m, b, (sum(n) * {UNIT} + sum(p)) // (sum(sum(n)) over (partition by lang, m) + {PRIOR}) as share from (
    select lang, m, b, n, 0 as p from buckets
    union all select lang, m, b, 0, share * {PRIOR} from (select distinct lang, m from buckets) join of_all using (m)
  ) group by lang, m, b
),
own as (
  select lang, source, m, b, sum(n) * {UNIT} + sum(p) as mass from (
    select lang, source, m, b, n, 0 as p from buckets
    union all select e.lang, source, e.m, b, 0, share * {PRIOR} from (select distinct lang, source, m from buckets) e
      join of_lang l on e.lang is not distinct from l.lang and e.m = l.m
  ) group by all
),
summed as (
  select *, sum(mass) over (partition by lang, source, m order by b) as upto, sum(mass) over (partition by lang, source, m) as size
  from own join (select distinct m, t from buckets) using (m)
),
found as (
  select lang, source, m, min(b) filter (upto * 1000 >= size * t) as top, min(b) filter (upto * 1000 >= size * 500) as middle,
    min(b) filter (upto * 1000 >= size * (1000 - t)) as bottom
  from summed group by all
),
outside as (
  select distinct k from long join found f on long.lang is not distinct from f.lang and long.source is not distinct from f.source and long.m = f.m
  where v > top + {REACH} * (top - middle) + {SLACK} or v < bottom - {REACH} * (middle - bottom) - {SLACK}
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and k not in (select k from outside) as kept
from valued
"""
