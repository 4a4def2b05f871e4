"""Collocations per language, from a weighted de Bruijn graph of phrases."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slipway.llm.frames import dropped, sized_shuffles, slices, stored
from slipway.llm.words import mix

# A phrase must occur so often; a phrase goes if a longer one that holds it has so many hundredths of its count.
LEAST, HELD = 10, 50
TOP = 2000
# Text whose edges are counted together, and the part of a longer text that is read at once.
STRETCH = 2 << 20
# Edges of a unary path that one row holds.
PATH = 256

# What ends a piece, and what ends a word within one.
_ENDS = rb".,;:!?\n-\r"
_SPACES = rb" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[[*b" \t"]] = 1
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 2
_WORD_END = re.compile(rb"[" + _ENDS + _SPACES + rb"]")
_TWO_WORDS = re.compile(rb"(?:[" + _SPACES + rb"]*[^" + _ENDS + _SPACES + rb"]+){0,2}")
_MOST = 1 << 62
# Buckets of phrases, and those of one chunk. More buckets leave out more in larger corpora, for a larger broadcast.
BUCKET_BITS, CHUNK_BITS = 28, 16


def _stretches(text: bytes) -> Iterator[tuple[bytes, int]]:
    """A text in stretches that end with a word, each followed by the two words that its last phrases need, and its size."""
    start = 0
    while True:
        found = _WORD_END.search(text, start + STRETCH) if len(text) - start > STRETCH else None
        if found is None:
            yield text[start:], len(text) - start
            return
        end = found.start()
        yield text[start : _TWO_WORDS.match(text, end).end()], end - start
        start = end


class _Read:
    """Stretches of text (text, size, language) as words by number, with the two that follow each in its piece."""

    def __init__(self, stretches: list[tuple[bytes, int, int]], langs: pa.Array) -> None:
        data = np.frombuffer(b"\n".join([*(text for text, _, _ in stretches), b""]), np.uint8)
        begins = np.cumsum([0, *(len(text) + 1 for text, _, _ in stretches)])
        kind = _KIND[data]
        inside = kind == 0
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        starts, ends = edges[::2], edges[1::2]
        offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(ends - starts, dtype=np.int32)])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
        words = pa.Array.from_buffers(pa.string(), len(starts), buffers).dictionary_encode()
        pieces = np.searchsorted(np.flatnonzero(kind == 2), starts)
        owner = np.searchsorted(begins, starts, side="right") - 1
        self.names, self.langs = words.dictionary, langs
        self.none = len(self.names)
        own = words.indices.to_numpy().astype(np.int64)

        def following(step: int) -> np.ndarray:
            after = np.full(len(own), self.none)
            same = pieces[step:] == pieces[: max(len(own) - step, 0)]
            after[: len(same)][same] = own[step:][same]
            return after

        limits = begins[:-1] + np.array([size for _, size, _ in stretches])
        begun = starts < limits[owner]
        self.own, self.second, self.third = own[begun], following(1)[begun], following(2)[begun]
        self.lang = np.array([lang for _, _, lang in stretches], np.int64)[owner][begun]

    def buckets(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of each word and the next, and that of all three. Where there are no such words, it means nothing."""
        factor, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
        hashes = np.array([*map(xxhash.xxh3_64_intdigest, self.names.to_pylist()), 0], np.uint64)
        langs = np.array([*map(xxhash.xxh3_64_intdigest, self.langs.to_pylist())], np.uint64)[self.lang]
        with np.errstate(over="ignore"):
            two = mix((langs * factor + hashes[self.own]) * factor + hashes[self.second])
            three = mix(two * factor + hashes[self.third])
        return (two >> shift).astype(np.int64), (three >> shift).astype(np.int64)


def _bucketed(reads: Iterable[_Read], bits: int) -> Iterator[pa.RecordBatch]:
    """How many phrases of two and three words fall in each bucket, for each chunk of buckets as places and counts."""
    for read in reads:
        two, three = read.buckets(bits)
        both = np.concatenate([two[read.second != read.none], three[read.third != read.none]])
        places, counts = np.unique(both, return_counts=True)
        edges = np.flatnonzero(np.diff(places >> CHUNK_BITS, prepend=-1, append=-1)) if len(places) else [0]
        rows = [
            (int(places[start] >> CHUNK_BITS), places[start:end].astype(np.uint16).tobytes(), np.minimum(counts[start:end], 255).astype(np.uint8).tobytes())
            for start, end in zip(edges[:-1], edges[1:], strict=True)
        ]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        kinds = (pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], ["chunk", "places", "counts"])


def _frequent(counted: DataFrame, least: int, bucket_bits: int) -> np.ndarray:
    """A bit for each bucket: whether ``least`` phrases or more fall in it. ``2 ** bucket_bits`` bits, whatever the corpus."""
    most = min(least, 255)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, places, counts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                own = sums.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.uint8))
                at = np.frombuffer(places, np.uint16)
                own[at] = np.minimum(own[at].astype(np.uint16) + np.frombuffer(counts, np.uint8), 255)
        for chunk, own in sums.items():
            bits = np.packbits(own >= most, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([bits], pa.binary())], ["chunk", "bits"])

    size = 1 << (CHUNK_BITS - 3)
    found = np.zeros(1 << (bucket_bits - 3), np.uint8)
    for row in counted.repartition("chunk").mapInArrow(run, "chunk int, bits binary").collect():
        found[row.chunk * size : (row.chunk + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return found


def _counted(read: _Read, frequent: np.ndarray | None) -> pa.RecordBatch:
    """The edges that begin in what was read, and how often each does."""
    own, second, third, none = read.own, read.second, read.third, read.none
    if frequent is not None:
        node, edge = ((frequent[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1 for at in read.buckets(len(frequent).bit_length() + 2))
        second = np.where(node, second, none)
        third = np.where(node & edge, third, none)
    codes, size = read.lang, len(read.langs)
    for column in (own, second, third):
        if size * (none + 1) > _MOST:
            known, codes = np.unique(codes, return_inverse=True)
            size = len(known)
        codes, size = codes * (none + 1) + column, size * (none + 1)
    _, at, counts = np.unique(codes, return_index=True, return_counts=True)

    def named(column: np.ndarray) -> pa.Array:
        return read.names.take(pa.array(column[at], mask=column[at] == none))

    node = pc.binary_join_element_wise(named(own), named(second), " ", null_handling="skip")
    columns = [read.langs.take(pa.array(read.lang[at])), node, named(third), pa.array(counts)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "node", "last", "n"])


def _reads(batches: Iterable[pa.RecordBatch]) -> Iterator[_Read]:
    for batch in slices(batches, most=STRETCH):
        own = batch["lang"].dictionary_encode()
        texts = zip(batch["text"].to_pylist(), own.indices.to_pylist(), strict=True)
        group: list[tuple[bytes, int, int]] = []
        held = 0
        for text, lang in texts:
            for part, size in _stretches(text.encode().lower()):
                if group and held + len(part) > STRETCH:
                    yield _Read(group, own.dictionary)
                    group, held = [], 0
                group.append((part, size, lang))
                held += len(part)
        if group:
            yield _Read(group, own.dictionary)


def phrase_edges(docs: DataFrame, least: int = 1, lang_column: str = "lang", text_column: str = "text", bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """``lang``, ``node``, ``last`` and ``n``: how often each phrase of three words occurs, as two words and the third.

    Such a phrase is an edge from the node of its first two words to that of its last two. Where a piece ends, ``last`` is
    null, and for its last word the node is that word alone: so each word of the text begins one edge or end.

    Only nodes and edges that occur ``least`` times matter to phrases that do. So phrases of two and three words are first
    counted by buckets of their hashes. An edge whose bucket has fewer counts as an end of its node, a node whose bucket has
    fewer as an end of its first word. Phrases that share a bucket only leave more of them in, so all counts are exact.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    shared = None
    if least > 1:
        counted = rows.mapInArrow(lambda batches: _bucketed(_reads(batches), bucket_bits), "chunk int, places binary, counts binary")
        shared = docs.sparkSession.sparkContext.broadcast(_frequent(counted, least, bucket_bits))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for read in _reads(batches):
            yield _counted(read, shared.value if shared else None)

    counted = rows.mapInArrow(run, "lang string, node string, last string, n long")
    return counted.groupBy("lang", "node", "last").agg(F.sum("n").alias("n"))


def _second_node(node: str = "node", last: str = "last") -> Column:
    return F.concat_ws(" ", F.substring_index(node, " ", -1), last)


def unary_paths(edges: DataFrame) -> DataFrame:
    """The edges (``lang``, ``node``, ``last``, ``n``) with ``head`` and ``place``: the path that each lies on, and where.

    Two edges follow each other on a path if the node between them has no other edge in or out. A path is named by its
    first edge. Each round doubles how far every edge looks back, so rounds grow with the logarithm of the longest path.
    Once a round brings no further edge to its path's head, the others run in circles; each is then a path of its own.
    """
    phrase = F.concat_ws(" ", "node", "last")
    leaving = edges.select("lang", "node", F.lit(1).alias("outs"), F.lit(0).alias("ins"), phrase.alias("edge"), F.lit(None).cast("string").alias("up"))
    arriving = edges.select("lang", _second_node().alias("node"), F.lit(0).alias("outs"), F.lit(1).alias("ins"), F.lit(None).cast("string").alias("edge"), phrase.alias("up"))
    between = leaving.union(arriving).groupBy("lang", "node").agg(
        F.sum("outs").alias("outs"), F.sum("ins").alias("ins"), F.max("edge").alias("edge"), F.max("up").alias("up")
    )
    links = between.where("outs = 1 and ins = 1 and edge <> up").select("lang", "edge", "up", F.lit(1).cast("long").alias("steps"), F.lit(True).alias("open"))
    links = stored(links, "links")
    left = -1
    while True:
        further = links.select("lang", F.col("edge").alias("up"), F.col("up").alias("_up"), F.col("steps").alias("_steps"))
        longer = links.join(further, ["lang", "up"], "left").select(
            "lang", "edge", F.coalesce("_up", "up").alias("up"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            F.col("_up").isNotNull().alias("open"),
        )
        longer = stored(longer, "links")
        dropped(links)
        links, before, left = longer, left, longer.where("open").count()
        if left in (0, before):
            break
    heads = links.where("not open").select("lang", F.col("edge").alias("_edge"), "up", "steps")
    named = edges.withColumn("_edge", phrase).join(heads, ["lang", "_edge"], "left")
    return named.select(
        "lang", "node", "last", "n", F.coalesce("up", "_edge").alias("head"), F.coalesce("steps", F.lit(0).cast("long")).alias("place")
    )


def _rows_of_paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Up to ``PATH`` edges of one path in a row, in order, each with the count of its first node."""
    counted = unary_paths(edges).join(nodes.withColumnRenamed("a", "flow"), ["lang", "node"])
    item = F.struct("place", "node", "last", "n", "flow")
    rows = counted.groupBy("lang", "head", F.floor(F.col("place") / PATH).alias("block")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return rows.select("lang", "items")


def _floored(a: str, left: str, right: str) -> str:
    a, left, right = (f"cast({column} as decimal(19, 0))" for column in (a, left, right))
    return f"(({a} * {a} * 1000000) div ({left} * {right}))"


def collocations(docs: DataFrame, least: int = LEAST, held: int = HELD, top: int = TOP, lang_column: str = "lang", text_column: str = "text", bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """Each language's ``top`` phrases of two or three words: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased in A-Z, cut into pieces at ``.,;:!?`` and line breaks, and these into words at spaces and tabs.
    ``n`` counts the language's words. Edges of the graph are phrases of three words, with their counts as weights. The
    count of a phrase of two words is the flow out of its node and the pieces that end there, that of a word the same over
    the nodes that begin with it. Edges of at least ``least`` are put together to unary paths. Within a path's row, the
    count of each edge's last two words is the next one's flow and a node's greatest longer phrase is its neighbour; only
    at the ends of rows are other tables asked.

    A phrase of ``a >= least`` is cut after the word where ``1000000 * a * a / (l * r)`` is least when rounded down, the
    first such. It goes if a longer one holds it and has at least ``held`` hundredths of its count. The order is by score,
    count and phrase. Arithmetic is that of decimals of 38 digits.

    A null language is ``und``; a null or empty text has no words. Repeated rows count each. Languages without a phrase
    that stays give no rows, as do empty tables. Other columns are left out.
    """
    with sized_shuffles(docs):
        edges = stored(phrase_edges(docs, least, lang_column, text_column, bucket_bits), "phrase-edges")
        nodes = edges.where(F.instr("node", " ") > 0).groupBy("lang", "node").agg(F.sum("n").alias("a"))
        nodes = stored(nodes.where(F.col("a") >= least), "phrase-nodes")
        words = edges.groupBy("lang", F.substring_index("node", " ", 1).alias("word")).agg(F.sum("n").alias("a"))
        words = stored(words, "phrase-words")
        heavy = stored(edges.where((F.col("n") >= least) & F.col("last").isNotNull()), "phrase-heavy")
        paths = stored(_rows_of_paths(heavy, nodes), "phrase-paths")
        found = stored(_ranked(paths, nodes, words, least, held, top), "phrases")
    dropped(edges, nodes, words, heavy, paths)
    return found


def _ranked(paths: DataFrame, nodes: DataFrame, words: DataFrame, least: int, held: int, top: int) -> DataFrame:
    # Edges with the count of their second node, where the row knows it.
    item = F.expr(
        "explode(transform(items, (x, i) -> named_struct('node', x.node, 'last', x.last, 'a', x.n, 'f12', x.flow,"
        " 'f23', get(items, i + 1).flow)))"
    )
    triples = paths.select("lang", item.alias("x")).select("lang", "x.*")
    ends = triples.where("f23 is null").drop("f23").withColumn("node2", _second_node())
    asked = ends.join(nodes.select("lang", F.col("node").alias("node2"), F.col("a").alias("f23")), ["lang", "node2"])
    columns = ["lang", "node", "last", "a", "f12", "f23"]
    triples = triples.where("f23 is not null").select(columns).union(asked.select(columns))
    triples = triples.select(
        "lang", F.concat_ws(" ", "node", "last").alias("phrase"), "a", F.substring_index("node", " ", 1).alias("first"),
        "last", "f12", "f23",
    )
    # Each node's greatest edge in or out; a row knows both sides of all nodes but its first and last.
    longer = F.expr(
        "explode(concat(transform(items, (x, i) -> named_struct('node', x.node, 'longer',"
        " greatest(x.n, get(items, i - 1).n))), array(named_struct('node', concat_ws(' ',"
        " substring_index(element_at(items, -1).node, ' ', -1), element_at(items, -1).last), 'longer', element_at(items, -1).n))))"
    )
    longer = paths.select("lang", longer.alias("x")).groupBy("lang", "x.node").agg(F.max("x.longer").alias("longer"))
    pairs = nodes.join(longer, ["lang", "node"], "left").where(f"longer is null or 100 * longer < {held} * a")
    missing = F.lit(None).cast("long")
    pairs = pairs.select(
        "lang", F.col("node").alias("phrase"), "a", F.substring_index("node", " ", 1).alias("first"),
        F.substring_index("node", " ", -1).alias("last"), missing.alias("f12"), missing.alias("f23"),
    )
    often = words.where(F.col("a") >= least)
    cut = (
        triples.union(pairs)
        .join(often.select("lang", F.col("word").alias("first"), F.col("a").alias("f1")), ["lang", "first"])
        .join(often.select("lang", F.col("word").alias("last"), F.col("a").alias("fn")), ["lang", "last"])
        .select("lang", "phrase", "a", F.col("f1").alias("l1"), F.coalesce("f23", "fn").alias("r1"), F.col("f12").alias("l2"), F.col("fn").alias("r2"))
        .withColumn("s1", F.expr(_floored("a", "l1", "r1")))
        .withColumn("s2", F.expr(f"case when l2 is not null then {_floored('a', 'l2', 'r2')} end"))
    )
    second = "s2 is not null and s2 < s1"
    scored = cut.select(
        "lang", "phrase", "a", F.expr(f"if({second}, l2, l1)").alias("l"), F.expr(f"if({second}, r2, r1)").alias("r"),
        F.expr(f"if({second}, s2, s1)").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (
    select lang, unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
  )
), numbered as (
  select lang, row_number() over () as piece, w from pieces where len(w) > 0
), words as (
  select lang, piece, unnest(w) as x, generate_subscripts(w, 1) as place from numbered
), following as (
  select lang, x, lead(x) over (partition by piece order by place) as y,
    lead(x, 2) over (partition by piece order by place) as z
  from words
), phrases as (
  select lang, 1 as size, x as phrase from following
  union all
  select lang, 2, x || ' ' || y from following where y is not null
  union all
  select lang, 3, x || ' ' || y || ' ' || z from following where z is not null
), counts as materialized (
  select lang, size, phrase, count(*) as a from phrases group by all
), totals as (
  select lang, sum(a)::bigint as n from counts where size = 1 group by lang
), candidates as (
  select lang, size, phrase, a, string_split(phrase, ' ') as w from counts where size > 1 and a >= 10
), longer as (
  select lang, phrase, max(a) as most
  from (
    select lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as phrase, a from candidates where size = 3
  ) group by all
), cuts as (
  select c.lang, c.phrase, c.a, k, l.a as l, r.a as r, (1000000::hugeint * c.a * c.a) // (l.a::hugeint * r.a) as score
  from (
    select lang, phrase, a, 1 as k, w[1] as first, array_to_string(w[2:], ' ') as rest from candidates
    union all
    select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from candidates where size = 3
  ) c
  join counts l on l.lang = c.lang and l.phrase = c.first
  join counts r on r.lang = c.lang and r.phrase = c.rest
), best as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (
  select b.*, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank
  from best b left join longer o on o.lang = b.lang and o.phrase = b.phrase
  where most is null or 100 * most < 50 * a
)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000
"""
