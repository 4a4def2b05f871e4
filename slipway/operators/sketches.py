"""Approximate aggregates that are stored by day and merged over any days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The logarithm of a sketch's size. Relative errors are about 1.04 / sqrt(2 ** LG) for distinct values (standard deviation).
LG = 12
# Of a quantile sketch: ranks are off by some 1.3 hundredths at 200.
K = 400


def daily_sketches(df: DataFrame, day: Column, keys: Sequence[str], member: str, measure: str) -> DataFrame:
    """One row per day and ``keys``: ``n`` rows, and sketches of the distinct ``member`` and of the distribution of ``measure``.

    ``members`` (HyperLogLog) can be merged, ``member_set`` (theta) merged, intersected and subtracted, ``measures`` (KLL) asked
    for quantiles. Sketches are filled where the rows are and only they are shuffled, so a frequent key meets in no task.
    Nulls are not counted in sketches. A day or key that is null is one of its own.
    """
    return df.groupBy(day.alias("day"), *keys).agg(
        F.count("*").alias("n"),
        F.hll_sketch_agg(member, F.lit(LG)).alias("members"),
        F.theta_sketch_agg(member, F.lit(LG)).alias("member_set"),
        F.kll_sketch_agg_double(F.col(measure).cast("double"), F.lit(K)).alias("measures"),
    )


def store_days(sketches: DataFrame, path: str) -> None:
    """Add days to the stored sketches at ``path``, or replace those that are there; other days stay as they are."""
    writer = sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(path)


def merged(spark: SparkSession, path: str, keys: Sequence[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """The sketches of all days from ``first`` to ``last``, both included, merged by ``keys``; only their folders are read."""
    days = spark.read.parquet(path)
    if first is not None:
        days = days.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        days = days.where(F.col("day") <= F.lit(last).cast("date"))
    return days.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.hll_union_agg("members").alias("members"), F.theta_union_agg("member_set").alias("member_set"),
        F.kll_merge_agg_double("measures").alias("measures"),
    )


def distinct_members(sketch: str = "members") -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile(share: float, sketch: str = "measures") -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(share))


def in_both(one: str, other: str) -> Column:
    """How many distinct members two theta sketches share."""
    return F.theta_sketch_estimate(F.theta_intersection(one, other))


def only_in(one: str, other: str) -> Column:
    return F.theta_sketch_estimate(F.theta_difference(one, other))
