"""The status table: one row per submission with what became of it.

Additions are small folders of their own. Once there are ``COMPACT_AFTER`` of them they become one segment, with a file for
each day and leading digit of the id, and a Bloom filter of each file's ids; ``FAN`` segments of one level become one of the
next. The segments that count are named by a version (``slipway.operators.versions``), so compaction may fail or run twice.
A question for some ids reads the filters of their digits, the files that may hold them, and the additions since.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from slipway.operators.versions import Version, VersionLog
from slipway.session import file_path, file_system, remove

STATUS_DDL = (
    "submission_id string, source_file string, type string, state string, error_condition string, "
    "error_message string, response string, results_path string, result_format string, deliveries bigint, "
    "started_at timestamp, finished_at timestamp"
)

# The answers a submitter gets.
PARSE_FAILURE = "Failed to parse code submission"
SUBMIT_FAILURE = "Failed to submit code"
ACCEPTED_SUFFIX = " code submitted"

# Additions that become a segment, and segments that become one of the next level.
COMPACT_AFTER = 64
FAN = 8
# Bits of a filter for each id, and bits that each id sets: of ids that a file does not hold, it lets 1 in 2,000 through.
BITS_PER_ID, BITS_SET = 16, 11
INDEX_DDL = "digit string, file string, words map<bigint, bigint>, size bigint"


def accepted(kind: Column) -> Column:
    return F.concat(kind, F.lit(ACCEPTED_SUFFIX))


def append_status(df: DataFrame, path: str) -> None:
    """Add status rows; columns that ``df`` lacks are null.

    Every addition is a folder of its own: writers that add to one folder at a time would delete each other's
    unfinished files.
    """
    fields = [field.strip().split(" ") for field in STATUS_DDL.split(",")]
    columns = [
        (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name) for name, kind in fields
    ]
    df.select(*columns).write.parquet(f"{path}/tail/{uuid.uuid4().hex}")


def append_status_if_any(df: DataFrame, path: str) -> None:
    """The same, without a folder for no rows."""
    if not df.isEmpty():
        append_status(df, path)


def append_status_rows(spark: SparkSession, rows: Iterable[tuple], path: str) -> None:
    schema = to_arrow_schema(StructType.fromDDL(STATUS_DDL))
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    if records:
        append_status(spark.createDataFrame(pa.Table.from_pylist(records, schema)).coalesce(1), path)


class StatusStore:
    """The status table below ``path`` as it is now."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.log = VersionLog(spark, path)
        version = self.log.latest()
        self.segments: list[dict] = version.content["segments"] if version else []
        absorbed = set(version.content["absorbed"]) if version else set()
        # Listed after the version was read: additions that a later version has taken up may be here still, and those that
        # are not here any more are in its segments, which is looked into again then.
        self.tail = [name for name in self._names("tail") if name not in absorbed]
        if (self.log.numbers() or [0])[-1] != (version.number if version else 0):
            self.__init__(spark, path)

    def _names(self, folder: str) -> list[str]:
        """Complete additions; one under way, or left by a writer that died, has no mark yet."""
        location = file_path(self.spark, f"{self.path}/{folder}")
        fs = file_system(self.spark, location)
        if not fs.exists(location):
            return []
        marks = fs.globStatus(file_path(self.spark, f"{self.path}/{folder}/*/_SUCCESS"))
        return sorted(mark.getPath().getParent().getName() for mark in marks)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], STATUS_DDL)
        return self.spark.read.schema(STATUS_DDL).option("recursiveFileLookup", "true").parquet(*paths)

    def _tail_paths(self) -> list[str]:
        return [f"{self.path}/tail/{name}" for name in self.tail]

    def rows(self) -> DataFrame:
        """All of it."""
        return self._read([*(f"{self.path}/{segment['folder']}/rows" for segment in self.segments), *self._tail_paths()])

    def files_for(self, ids: DataFrame) -> list[str]:
        """The segments' files that may hold one of ``ids`` (``submission_id``), by their filters."""
        if not self.segments:
            return []
        index = self.spark.read.schema(INDEX_DDL).option("recursiveFileLookup", "true").parquet(
            *(f"{self.path}/{segment['folder']}/index" for segment in self.segments)
        )
        asked = ids.select(_digit().alias("digit"), *[_hash(n).alias(f"h{n}") for n in range(BITS_SET)]).distinct()
        held = F.lit(True)
        for n in range(BITS_SET):
            place = F.pmod(F.col(f"h{n}"), F.col("size") * 64)
            word = F.coalesce(F.col("words")[F.floor(place / 64)], F.lit(0).cast("long"))
            held = held & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
        return sorted(row.file for row in index.join(asked, "digit").where(held).select("file").distinct().toLocalIterator())

    def known(self, ids: DataFrame) -> DataFrame:
        """The rows whose ``submission_id`` is among ``ids``; only files that may hold one are read."""
        paths = [*(f"{self.path}/{file}" for file in self.files_for(ids)), *self._tail_paths()]
        return self._read(paths).join(ids.select("submission_id"), "submission_id", "left_semi")

    def compact(self, after: int = COMPACT_AFTER, fan: int = FAN) -> bool:
        """Turn the additions into a segment if there are ``after`` of them; whether this has changed the store.

        The segment is written first and counts once a version names it. Should another have put a version meanwhile, this
        one's work is thrown away. What a compaction has taken up is deleted by the next one, before that puts its version:
        so reads under way find it, and nothing is left behind that no version knows of.
        """
        if len(self.tail) < after:
            return False
        base = self.log.latest()
        for name in base.content["absorbed"] + base.content["replaced"] if base else []:
            remove(self.spark, f"{self.path}/{name if name.startswith('segment-') else 'tail/' + name}")
        merged, level = [], 0
        while len(same := [s for s in self.segments if s["level"] == level]) >= fan - 1:
            merged += same
            level += 1
        folder = f"segment-{uuid.uuid4().hex}"
        source = self._read([*(f"{self.path}/{s['folder']}/rows" for s in merged), *self._tail_paths()])
        self._write_segment(source, folder)
        segments = [s for s in self.segments if s not in merged] + [{"folder": folder, "level": level}]
        content = {"segments": segments, "absorbed": self.tail, "replaced": [s["folder"] for s in merged]}

        def change(latest: Version | None) -> dict | None:
            return content if (latest.number if latest else 0) == (base.number if base else 0) else None

        if self.log.commit(change) is None:
            remove(self.spark, f"{self.path}/{folder}")
            return False
        self.log.tidy(lambda _: set())
        self.__init__(self.spark, self.path)
        return True

    def _write_segment(self, source: DataFrame, folder: str) -> None:
        root = f"{self.path}/{folder}"
        day = F.coalesce(F.to_date("finished_at"), F.to_date("started_at"))
        keyed = source.withColumn("day", day).withColumn("digit", _digit())
        keyed.repartition("day", "digit").sortWithinPartitions("day", "digit").write.partitionBy("day", "digit").parquet(f"{root}/rows")
        rows = self.spark.read.schema(f"{STATUS_DDL}, day date, digit string").parquet(f"{root}/rows")
        file = F.regexp_extract(F.input_file_name(), f"({folder}/rows/.*)$", 1)
        ids = rows.select("digit", file.alias("file"), "submission_id").where("submission_id is not null")
        sizes = ids.groupBy("digit", "file").agg(F.ceil(F.count("*") * BITS_PER_ID / 64).alias("size"))
        places = F.explode(F.array(*[F.pmod(_hash(n), F.col("size") * 64) for n in range(BITS_SET)])).alias("place")
        words = (
            ids.join(sizes, ["digit", "file"]).select("digit", "file", "size", places)
            .groupBy("digit", "file", "size", F.floor(F.col("place") / 64).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")).alias("bits"))
        )
        entries = F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words")
        words.groupBy("digit", "file", "size").agg(entries).select("digit", "file", "words", "size").write.parquet(f"{root}/index")


def _digit() -> Column:
    return F.substring("submission_id", 1, 1)


def _hash(number: int) -> Column:
    return F.xxhash64(F.lit(number), F.col("submission_id"))


def status_table(spark: SparkSession, path: str) -> DataFrame:
    """The status table; empty if nothing was recorded yet."""
    return StatusStore(spark, path).rows()
