"""Functions that submitted SQL can call by name."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def register_sql_function(session: SparkSession, name: str, parameters: str, returns: str, body: str) -> None:
    """A scalar function written as an SQL expression. Spark puts the expression in place of each call."""
    session.sql(f"create or replace temporary function {name}({parameters}) returns {returns} return {body}")


def register_vectorized(
    session: SparkSession, name: str, function: Callable[[pd.Series], pd.Series], returns: DataType | str
) -> None:
    """A scalar function written in Python over column batches."""
    session.udf.register(name, F.pandas_udf(function, returns))


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean of ``value`` per ``key``, with the summing in Python.

    Each batch is summed where it is read, so only one small row per batch and key is shuffled and a frequent key
    never meets in one task. Keys stay as they are, also null and large ones. A key without values has a null mean.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by("key").aggregate([("value", "sum"), ("value", "count")])
            yield from sums.select(["key", "value_sum", "value_count"]).to_batches()

    plain = df.select(F.col(key).alias("key"), F.col(value).cast("double").alias("value"))
    kind = plain.schema["key"].dataType.simpleString()
    partials = plain.mapInArrow(partial, f"key {kind}, value_sum double, value_count bigint")
    mean = F.try_divide(F.sum("value_sum"), F.sum("value_count"))
    return partials.groupBy(F.col("key").alias(key)).agg(mean.alias("mean"))


def register_lines(session: SparkSession, name: str = "lines") -> None:
    """A table function: the lines of a text, numbered from 0."""

    # Defined here, it is sent to the executors with the query, which then need no copy of this package.
    class Lines:
        def eval(self, text: str):
            if text is not None:
                yield from enumerate(text.split("\n"))

    session.udtf.register(name, F.udtf(Lines, returnType="i int, line string"))
