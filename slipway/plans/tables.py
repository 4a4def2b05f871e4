"""The tables that the queries read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from slipway.session import Setup

_schemas: dict[str, StructType] = {}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``<folder>/<name>.parquet``. Its schema is read once: the tables do not change while queries run."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def views(folder: str, names: Iterable[str]) -> Setup:
    """A session's setup: each table as a temp view of its name."""

    def setup(session: SparkSession) -> None:
        for name in names:
            read_table(session, folder, name).createOrReplaceTempView(name)

    return setup
