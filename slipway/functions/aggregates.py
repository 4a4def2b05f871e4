"""Aggregates written in Python that work in two phases, registered by name."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from slipway.functions.columns import column
from slipway.session import remove, work_path

# States of one key that a task merges at a time, and keys that a task holds before it passes their states on.
FAN_IN = 64
HELD_KEYS = 50_000


class Aggregator:
    """What an aggregate does with a state of its own kind, which must not grow with the number of rows.

    ``returns`` is the result's type. ``update`` sees rows of one key by the batch, a column for each argument.
    """

    returns = "double"

    def init(self) -> Any:
        raise NotImplementedError

    def update(self, state: Any, *values: pd.Series) -> Any:
        raise NotImplementedError

    def merge(self, state: Any, other: Any) -> Any:
        raise NotImplementedError

    def finish(self, state: Any) -> Any:
        raise NotImplementedError


class WeightedMedian(Aggregator):
    """The least value up to which half of all weight lies; null without weight. Its state has a number for each
    different value, so it is for columns of few of them. Rows with a null or a weight that is not positive do not count."""

    def init(self) -> Counter:
        return Counter()

    def update(self, state: Counter, values: pd.Series, weights: pd.Series) -> Counter:
        counted = values.notna() & weights.notna() & (weights > 0)
        state.update(weights[counted].groupby(values[counted].astype(float)).sum().to_dict())
        return state

    def merge(self, state: Counter, other: Counter) -> Counter:
        state.update(other)
        return state

    def finish(self, state: Counter) -> float | None:
        half, so_far = sum(state.values()) / 2, 0
        for value in sorted(state):
            so_far += state[value]
            if so_far >= half:
                return value
        return None


class Largest(Aggregator):
    """The ``count`` largest values, the largest first; nulls do not count."""

    returns = "array<double>"

    def __init__(self, count: int) -> None:
        self.count = count

    def init(self) -> list[float]:
        return []

    def update(self, state: list[float], values: pd.Series) -> list[float]:
        return self.merge(state, values.dropna().astype(float).nlargest(self.count).tolist())

    def merge(self, state: list[float], other: list[float]) -> list[float]:
        return sorted([*state, *other], reverse=True)[: self.count]

    def finish(self, state: list[float]) -> list[float]:
        return state


class AggregateRegistry:
    """Aggregates by name. ``aggregate`` runs one over any table."""

    def __init__(self) -> None:
        self._known: dict[str, Aggregator] = {}

    def register(self, name: str, aggregator: Aggregator) -> None:
        if name in self._known:
            raise ValueError(f"aggregate {name!r} is already registered")
        self._known[name] = aggregator

    def aggregate(self, df: DataFrame, keys: Sequence[str], name: str, arguments: Sequence[str], output: str) -> DataFrame:
        if name not in self._known:
            raise LookupError(f"no aggregate is registered as {name!r}")
        return aggregate_by(df, keys, self._known[name], arguments, output)


def aggregate_by(
    df: DataFrame, keys: Sequence[str], aggregator: Aggregator, arguments: Sequence[str], output: str, fan_in: int = FAN_IN
) -> DataFrame:
    """One row per different ``keys``, with the aggregate of ``arguments`` as ``output``.

    Rows are added up where they are read, so a key's rows never meet; its states, one or a few from each partition,
    are written as binary and merged ``fan_in`` at a time, over as many rounds as the key with most of them needs. Null
    keys are a key; an empty table gives no rows. Other columns are not read. The states stay in the work folder.
    """
    spark = df.sparkSession
    names = [f"k{at}" for at in range(len(keys))]
    inputs = [f"a{at}" for at in range(len(arguments))]
    plain = df.select(
        *(column(key).alias(name) for key, name in zip(keys, names, strict=True)),
        *(column(key).alias(name) for key, name in zip(arguments, inputs, strict=True)),
    )
    kinds = [f"{name} {plain.schema[name].dataType.simpleString()}" for name in names]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[pa.Table, Any]] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for key, state in held.values():
                yield from key.append_column("state", pa.array([pickle.dumps(state)], pa.binary())).to_batches()
            held.clear()

        for batch in batches:
            rows = pa.table({**{name: batch[name] for name in names}, "row": pa.array(range(batch.num_rows), pa.int64())})
            groups = rows.group_by(names, use_threads=False).aggregate([("row", "list")])
            columns = [batch[name].to_pandas() for name in inputs]
            for at, places in enumerate(groups["row_list"].to_pylist()):
                key = groups.select(names).slice(at, 1)
                name = tuple(part[0].as_py() for part in key.columns)
                first, state = held.get(name) or (key, aggregator.init())
                held[name] = first, aggregator.update(state, *(values.iloc[places] for values in columns))
            if len(held) >= HELD_KEYS:
                yield from passed_on()
        yield from passed_on()

    def together(table: pa.Table) -> Any:
        return reduce(aggregator.merge, map(pickle.loads, table["state"].to_pylist()))

    def merge(table: pa.Table) -> pa.Table:
        return table.select(names).slice(0, 1).append_column("state", pa.array([pickle.dumps(together(table))], pa.binary()))

    def finish(table: pa.Table) -> pa.Table:
        frame = pa.array([aggregator.finish(together(table))], result_type)
        return table.select(names).slice(0, 1).append_column("result", frame)

    def kept(states: DataFrame) -> tuple[DataFrame, str]:
        path = work_path(spark, "states")
        states.write.parquet(path)
        return spark.read.schema(states.schema).parquet(path), path

    result_type = to_arrow_type(StructType.fromDDL(f"result {aggregator.returns}")["result"].dataType)
    schema = ", ".join([*kinds, "state binary"])
    states, path = kept(plain.mapInArrow(partial, schema))
    while (most := _most_states(states, names)) > fan_in:
        share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-most // fan_in)))
        fewer, following = kept(states.withColumn("share", share).groupBy(*names, "share").applyInArrow(merge, schema))
        remove(spark, path)
        states, path = fewer, following
    found = states.groupBy(*names).applyInArrow(finish, ", ".join([*kinds, f"result {aggregator.returns}"]))
    named: list[Column] = [F.col(name).alias(key) for key, name in zip(keys, names, strict=True)]
    return found.select(*named, F.col("result").alias(output))


def _most_states(states: DataFrame, names: Sequence[str]) -> int:
    return states.groupBy(*names).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
