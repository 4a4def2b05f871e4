"""Near duplicates by SimHash, found through deletion variants of fingerprint halves."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.llm.components import connected_components
from slipway.llm.frames import hamming, identified_texts, slices, stored
from slipway.llm.similar_texts import one_of_each  # noqa: F401

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
# Shingles of one text whose bits are counted at once, so that a very long text takes no more memory than its words.
STRETCH = 1 << 16

_HALF = 0xFFFFFFFF


def _shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    """Every run of ``size`` words, space-joined; fewer words make one shingle, none makes none."""
    size = min(size, len(words))
    return map(b" ".join, zip(*(itertools.islice(words, at, None) for at in range(size)), strict=False))


def simhash(text: str, size: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed long: a bit is 1 if it is in more than half of the shingles' XXH64.

    Words are runs without ASCII white space, after A-Z became a-z. No words: zero.
    """
    words = text.encode().lower().split()
    hashes = map(xxhash.xxh64_intdigest, _shingles(words, size), itertools.repeat(SEED))
    counts, total = np.zeros(64, np.int64), 0
    while len(values := np.fromiter(itertools.islice(hashes, STRETCH), np.uint64)):
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
        total += len(values)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprints(texts: DataFrame) -> DataFrame:
    """``id`` and ``fingerprint`` (long) of ``id`` and ``text``, text by text, whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array([simhash(text) for text in batch["text"].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["id"], found], ["id", "fingerprint"])

    return texts.mapInArrow(run, "id long, fingerprint long")


def _dealt(nodes: DataFrame) -> DataFrame:
    """Fingerprints are small and their variants many, so the files that hold them would make too few tasks."""
    return nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fingerprint")


def _variants(nodes: DataFrame) -> DataFrame:
    """For either half of the fingerprint and each of its 32 bits: the half without that bit.

    Two halves that differ in one bit at most share a variant.
    """
    halves = F.array(
        F.col("fingerprint").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned("fingerprint", 32)
    )
    place = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("place")
    spread = _dealt(nodes).select("fingerprint", "label", halves.alias("halves"), place)
    half = F.element_at("halves", (F.col("place") / 32).cast("int") + 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(32)))
    return spread.select("place", half.bitwiseAND(F.bitwise_not(bit)).alias("value"), "fingerprint", "label")


def _one_bit_links(nodes: DataFrame) -> DataFrame:
    """Fingerprints that differ in one bit: without it they are equal, and no third one is."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place"))
    spread = _dealt(nodes).select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("place"))
    return (
        spread.groupBy("place", F.col("fingerprint").bitwiseAND(F.bitwise_not(bit)).alias("rest"))
        .agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b"))
        .where("a <> b")
        .select("a", "b")
    )


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``fingerprint`` and ``label``: that of its component, else itself."""
    return nodes.join(labels, nodes["fingerprint"] == labels["node"], "left").select(
        "fingerprint", F.coalesce("label", "fingerprint").alias("label")
    )


def _links_between(nodes: DataFrame, radius: int) -> DataFrame:
    """Links between fingerprints whose labels differ, as pairs of labels.

    Buckets of one variant are first reduced to their least and greatest label: those with one label only, such as all
    that a large group of near copies fills, are never gathered. Two members are compared there and then; the members
    of what is left are fetched and joined.
    """
    variants = _variants(nodes)
    member = F.struct("label", "fingerprint")
    buckets = stored(
        variants.groupBy("place", "value")
        .agg(F.count("*").alias("n"), F.min(member).alias("low"), F.max(member).alias("high"))
        .where("low.label <> high.label"),
        "buckets",
    )
    pairs = buckets.where("n = 2").where(hamming("low.fingerprint", "high.fingerprint") <= radius)
    members = stored(variants.join(buckets.where("n > 2").select("place", "value"), ["place", "value"]), "members")
    left, right = members.alias("l"), members.alias("r")
    joined = left.join(
        right,
        (F.col("l.place") == F.col("r.place"))
        & (F.col("l.value") == F.col("r.value"))
        & (F.col("l.label") < F.col("r.label"))
        & (hamming("l.fingerprint", "r.fingerprint") <= radius),
    )
    return pairs.select(F.col("low.label").alias("a"), F.col("high.label").alias("b")).union(
        joined.select(F.col("l.label").alias("a"), F.col("r.label").alias("b"))
    )


def _hex(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def near_duplicates(
    table: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS
) -> DataFrame:
    """One row per row of ``table``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    The 64 bits are cut into two halves. Of fingerprints that differ in ``radius`` (at most 3) bits or fewer, one half
    differs in at most one, so the pair shares a variant of it; the equality join on variants loses none. Equal
    fingerprints are one node. Fingerprints one bit apart are joined first, since a large group of near copies is tied
    together by such links; only links between the resulting parts are searched for then.

    ``component_id`` is the least id that links reach. A null text counts as empty, empty texts have fingerprint zero
    and link like any other. Repeated rows come back each. A null id gets its component's least id, or null if there
    is none. An empty table gives no rows. Other columns are left out.
    """
    if not 0 <= radius <= 3:
        raise ValueError("two halves with one free bit find at most three differing bits")
    found = stored(fingerprints(identified_texts(table, id_column, text_column)), "fingerprints")
    nodes = stored(found.groupBy("fingerprint").agg(F.min("id").alias("least_id")), "nodes")
    distinct = nodes.select("fingerprint")
    near = stored(_labelled(distinct, connected_components(_one_bit_links(distinct))) if radius else
                  distinct.select("fingerprint", F.col("fingerprint").alias("label")), "labels")
    if radius > 1:
        merged = connected_components(_links_between(near, radius))
        near = near.join(merged, near["label"] == merged["node"], "left").select(
            "fingerprint", F.coalesce(merged["label"], near["label"]).alias("label")
        )
    named = near.join(nodes, "fingerprint")
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    components = named.join(least, "label").select("fingerprint", "component_id")
    return found.join(components, "fingerprint").select(
        F.col("id").alias(id_column), _hex("fingerprint").alias("fingerprint"), "component_id"
    )
