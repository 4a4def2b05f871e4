"""WARC archives of pages, and one index over all of them in URL and time order."""

from __future__ import annotations

import gzip
import io
import re
import string
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slipway.llm.frames import stored
from slipway.session import work_path

# Index rows for a merging task.
MERGE_ROWS = 100_000
# Page 0 counts as captured then, each further one a second later; the tables have no times of their own.
FIRST_CAPTURE = "2024-01-01T00:00:00Z"

_END = "\r\n"
_BETWEEN = "\r\n\r\n"
_URN = "urn:slipway:page:"
_BASE32 = string.ascii_uppercase + "234567"
_HEX32 = string.digits + string.ascii_uppercase[:22]

INDEX_SCHEMA = (
    "run string, place long, url_key string, captured_at string, page_id long, url string, record_type string, "
    "payload_bytes long, payload_digest string, refers_to long"
)


def base32_sha1(payload: Column) -> Column:
    """The bare base32 SHA-1: each 5 hexadecimal digits are 4 of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * part + 1, 5), 16, 32), 4, "0") for part in range(8)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def _captures(pages: DataFrame) -> DataFrame:
    """Each page with its payload, the payload's size and digest, and when it was captured."""
    payload = F.coalesce("html", F.lit(""))
    moment = F.unix_seconds(F.lit(FIRST_CAPTURE).cast("timestamp")) + F.coalesce("page_id", F.lit(0))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload.cast("binary")).alias("payload_digest"),
        F.date_format(F.timestamp_seconds(moment), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at"),
    )


def _record(refers_to: Column) -> Column:
    """The record's text without the blank lines that end it."""
    response = refers_to.isNull()
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.col("payload_bytes"), F.lit(_BETWEEN),
    )
    block = F.when(response, F.concat(head, F.col("payload"))).otherwise(F.lit(""))
    # A line break in a URL would end the header.
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(response, "response").otherwise("revisit")),
        F.concat(F.lit(f"WARC-Record-ID: <{_URN}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Date: "), F.col("captured_at")),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes")),
        F.concat(F.lit(f"WARC-Refers-To: <{_URN}"), refers_to, F.lit(">")),
        F.when(~response, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(response, F.lit("Content-Type: application/http; msgtype=response")),
        F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    ]
    # A field that is null, as the reference of a response is, is left out.
    return F.concat(F.concat_ws(_END, *fields), F.lit(_BETWEEN), block)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``) into gzipped archives below ``path``.

    Of records whose payloads are equal and have ``least_bytes`` bytes or more, that with the largest ``page_id`` is the
    response, and the others revisit it. Payloads are compared by digest and size. Only these are grouped, with partial
    maxima before the shuffle, and the maxima written; then every page meets its group's in one join, whose large
    partitions adaptive execution splits, as nothing is aggregated within it, and goes straight to its archive. A null html is an empty payload. Rows without a page_id revisit
    a group's largest; if no row of a group has one, all are responses. Rows that repeat the largest are each responses.
    """
    captures = _captures(pages)
    groups = captures.select("payload_digest", "payload_bytes", "page_id")
    sizes = groups.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("response_id"))
    sizes = sizes.withColumnsRenamed({"payload_digest": "_digest", "payload_bytes": "_bytes"})
    joined = captures.join(stored(sizes, "payloads"), F.expr("payload_digest = _digest and payload_bytes = _bytes"))
    revisits = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    refers_to = F.when(revisits, F.col("response_id"))
    joined.select(_record(refers_to).alias("value")).write.option("compression", "gzip").option(
        "lineSep", _BETWEEN
    ).text(path)


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record; read one at a time, by the lengths they state."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record is cut off")
        yield fields, block


def url_key(url: str) -> str:
    """The host's labels from last to first, then path and query: ``org,example)/a?b``."""
    scheme, found, rest = url.partition("://")
    host, path = re.fullmatch(r"([^/?#]*)([^#]*).*", rest if found else scheme, re.DOTALL).groups()
    host = host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return ",".join(reversed(host.split("."))) + ")" + path


def _page_id(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(_URN)
    return int(number) if number else None


def _run_of(name: str, archive: bytes) -> list[tuple]:
    """The index rows of one archive in order of URL key, time and page."""
    rows = []
    with gzip.open(io.BytesIO(archive)) as stream:
        for fields, block in records(stream):
            if fields["warc-type"] == "response":
                size = len(block) - block.index(b"\r\n\r\n") - 4
                if size != int(fields["x-payload-length"]):
                    raise ValueError("a payload's length differs from what its record states")
            url = fields.get("warc-target-uri", "")
            rows.append(
                (
                    url_key(url), fields["warc-date"], _page_id(fields["warc-record-id"]), url, fields["warc-type"],
                    int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:"),
                    _page_id(fields.get("warc-refers-to")),
                )
            )
    rows.sort(key=_order)
    return [(name, place, *row) for place, row in enumerate(rows)]


def _order(row: tuple) -> tuple[bytes, str, int]:
    return row[0].encode(), row[1], -1 if row[2] is None else row[2]


def sorted_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index of every archive below ``path``, each a run of its own, in order within itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, archive in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                if rows := _run_of(name, archive.as_buffer().to_pybytes()):
                    yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = [field.split()[0] for field in INDEX_SCHEMA.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64()}[field.split()[1]] for field in INDEX_SCHEMA.split(", ")]
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return archives.select("path", "content").mapInArrow(run, INDEX_SCHEMA)


def loser_tree_merge(runs: list[Iterable[Any]], key: Callable[[Any], Any]) -> Iterator[Any]:
    """All items of sorted ``runs`` in order; equal keys in the order of their runs.

    Leaves are the runs' next items. Each inner node keeps the loser of its match, so that after the winner is taken one
    match per level, along its path to the top, finds the next one.
    """
    sources = [iter(run) for run in runs]
    count = len(sources)
    if not count:
        return
    ended = (1,)

    def following(run: int) -> tuple:
        for item in sources[run]:
            return 0, key(item), run, item
        return ended

    heads = [following(run) for run in range(count)]

    def beats(a: int, b: int) -> bool:
        return heads[a][:3] < heads[b][:3]

    losers, winners = [0] * count, [0] * count + [*range(count)]
    for node in range(count - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    winner = winners[1]
    while heads[winner] is not ended:
        yield heads[winner][3]
        heads[winner] = following(winner)
        node = (winner + count) // 2
        while node:
            if beats(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2


def merged_index(runs: DataFrame) -> DataFrame:
    """The rows of all runs in one order, by URL key, time and page, with ``position`` from 0 on.

    The key space is cut where a sample says, so that tasks get about ``MERGE_ROWS`` rows each, also where one URL has
    very many: the time and the page are part of the key. A task holds the part of every run that falls into its range,
    in the run's own order, and merges these by a loser tree. Positions need only the number of rows in each range.
    """
    spark = runs.sparkSession
    runs = stored(runs, "runs")
    count = max(1, -(-runs.count() // MERGE_ROWS))
    order = ["url_key", "captured_at", F.coalesce("page_id", F.lit(-1))]
    ranged = runs.repartitionByRange(count, *order).sortWithinPartitions("run", "place")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                found.setdefault(row["run"], []).append(row)
        order = loser_tree_merge(
            [*found.values()],
            lambda row: (row["url_key"].encode(), row["captured_at"], -1 if row["page_id"] is None else row["page_id"]),
        )
        rows = [{**row, "place": place} for place, row in enumerate(order)]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([(field.split()[0], {"string": pa.string(), "long": pa.int64()}[field.split()[1]]) for field in INDEX_SCHEMA.split(", ")])
    merged = ranged.mapInArrow(merge, INDEX_SCHEMA).withColumn("part", F.spark_partition_id())
    merged = stored(merged, "merged")
    # One row per range, a hundred thousand times fewer than there are captures.
    parts = merged.groupBy("part").agg(F.count("*").alias("n"))
    before = parts.selectExpr("part", "sum(n) over (order by part) - n as before")
    return merged.join(F.broadcast(before), "part").withColumn("position", F.col("before") + F.col("place")).drop(
        "part", "before", "place"
    )


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages``, read them back and merge their index: one row per page with ``page_id``,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, and its ``position`` among all captures.

    Archives and index stay below the shared work folder. An empty table gives no rows; other columns are left out; see
    ``write_archives`` for nulls and equal payloads.
    """
    path = work_path(pages.sparkSession, "archives")
    write_archives(pages.select("page_id", "url", "html"), path)
    return merged_index(sorted_runs(pages.sparkSession, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "position"
    )


WARC_ORACLE = f"""
with captures as (
  select page_id, coalesce(url, '') as url, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages
),
keyed as (
  select *, max(page_id) over (partition by payload) as response_id,
    array_to_string(list_reverse(string_split(translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '.')), ',')
      || ')' || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) as url_key
  from (select *, case when contains(url, '://') then regexp_extract(url, '://((?s).*)', 1) else url end as rest from captures)
)
select page_id, octet_length(encode(payload))::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}',
    (((('0x' || substr(digest, (i // 4 * 5 + 1)::int, 5))::bigint >> (5 * (3 - i % 4))::int) & 31) + 1)::int, 1)), '') as payload_digest,
  case when page_id = response_id then 'response' else 'revisit' end as record_type,
  case when page_id <> response_id then response_id end as refers_to,
  row_number() over (order by url_key, page_id) - 1 as position
from keyed
"""
