"""Row positions over a distributed sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slipway.functions.columns import column
from slipway.session import partitions_for, remove, work_path

_LOW_33_BITS = (1 << 33) - 1


def sorted_table(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order_by``, written to the work folder and read back.

    ``_part`` numbers the sort partitions in order and ``_pos`` the rows within each. The rows are first written with a
    number each, without a shuffle, and sorted by that last. So every row has a place of its own, and a value that many
    rows share, or a row that has many copies, is spread over several partitions. Both tables fix what they hold: a
    later stage or a lost executor cannot see another numbering or split. ``order_by`` names columns of ``df``.
    """
    spark = df.sparkSession
    numbered = work_path(spark, "numbered")
    df.select("*", F.monotonically_increasing_id().alias("_copy")).write.parquet(numbered)
    rows = spark.read.parquet(numbered)
    path = work_path(spark, "sorted")
    (
        rows.repartitionByRange(partitions_for(rows), *order_by, "_copy")
        .sortWithinPartitions(*order_by, "_copy")
        .select(
            *[column(name) for name in df.columns],
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_33_BITS)).alias("_pos"),
        )
        .write.parquet(path)
    )
    remove(spark, numbered)
    return spark.read.parquet(path)


def with_row_index(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """Number the rows 0, 1, 2 … in the order of ``order_by``; rows it does not tell apart are in any order.

    Only the row count of each sort partition, one row per partition, is brought together and broadcast.
    """
    table = sorted_table(df, order_by)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        table.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return table.join(F.broadcast(offsets), "_part").select(
        *[column(c) for c in df.columns], (F.col("_offset") + F.col("_pos")).alias(name)
    )
