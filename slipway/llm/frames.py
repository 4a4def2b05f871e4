"""What the operators share: columns chosen by name, stored tables, and batches of bounded size."""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slipway.session import partitions_for, remove, work_path

# Text that a Python task holds at once, unless one text alone is longer.
SLICE_BYTES = 4 << 20


def identified_texts(table: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id`` and ``text`` of every row; other columns go, whatever their names. A null text is an empty one."""
    return table.select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a new folder below the shared work folder and read again.

    This cuts the lineage with files that outlive any executor, and gives later joins a known size.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete the folders of stored tables that nothing reads any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()[:1]}:
            remove(table.sparkSession, folder)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``most`` bytes of ``column``, or of one row."""
    for batch in batches:
        start, held = 0, 0
        sizes = [0 if value is None else value for value in pc.binary_length(batch[column]).to_pylist()]
        for at, size in enumerate(sizes):
            if at > start and held + size > most:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def hamming(left: str | Column, right: str | Column) -> Column:
    """How many bits of two longs differ."""
    left = F.col(left) if isinstance(left, str) else left
    right = F.col(right) if isinstance(right, str) else right
    return F.bit_count(left.bitwiseXOR(right))


@contextlib.contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[None]:
    """While it lasts, shuffles begin with as many partitions as the input of ``df`` calls for.

    Adaptive execution joins the small ones. It is for work that is done, by writing it, before the end.
    """
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(setting, None)
    conf.set(setting, partitions_for(df))
    try:
        yield
    finally:
        conf.unset(setting) if before is None else conf.set(setting, before)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """While it lasts, the shuffle files of a query go when it has ended, not when the driver happens to collect garbage.

    It is for work that is done, by writing it, before the end: no table may be computed twice from one query's plan.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
