"""Table functions by name that take a whole table and give columns that follow from it."""

from __future__ import annotations

import functools
import operator
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipway.session import partitions_for

_PART = "_part"

# The batch forms of table functions, by session and name.
_batch_forms: dict[tuple[str, str], type] = {}


def _known_as(session: SparkSession, name: str) -> tuple[str, str]:
    return session._jsparkSession.sessionUUID(), name.lower()


def register_table_function(session: SparkSession, name: str, function: type, batches: type | None = None) -> None:
    """A table function, called as ``name(table(t) partition by k order by (v), …)``.

    ``function`` has ``analyze``, a static method that gives the result's columns from the arguments, and ``eval``, called
    for each row of a partition in its order. It is sent with the query if it is defined within a function; otherwise
    executors need its module.

    ``batches`` is the same function over batches: its ``eval`` takes a `pyarrow.RecordBatch` of rows of one partition in
    its order, and the other arguments as arrays, and yields tables with the columns of the input. Spark wants to know
    the columns of such a function beforehand, so only `in_parts`, which has the table, calls it.
    """
    # With Arrow, Spark would write a batch for each row that goes in, even if none comes out.
    session.udtf.register(name, F.udtf(function, useArrow=False))
    if batches is None:
        _batch_forms.pop(_known_as(session, name), None)
    else:
        _batch_forms[_known_as(session, name)] = batches


def register_first_rows(session: SparkSession, name: str = "first_rows") -> None:
    """``first_rows(table(t) partition by k order by (v), n)``: the first ``n`` rows of each partition, with all columns.

    What follows the ``n`` rows is not handed to Python code. It may be called in parts, see `in_parts`.
    """

    class FirstRows:
        @staticmethod
        def analyze(table, n):
            from pyspark.sql.udtf import AnalyzeResult

            if not table.isTable:
                raise ValueError("the first argument is a table")
            if not n.isConstantExpression or isinstance(n.value, bool) or not isinstance(n.value, int) or n.value < 0:
                raise ValueError("the second argument is a number of rows, 0 or more, that does not depend on any row")
            return AnalyzeResult(schema=table.dataType)

        def __init__(self):
            self.held = 0

        def eval(self, row, n):
            from pyspark.sql.functions import SkipRestOfInputTableException

            if self.held == n:
                raise SkipRestOfInputTableException
            self.held += 1
            yield tuple(row)

    class FirstRowsOfBatches:
        def __init__(self):
            self.held = 0

        def eval(self, batch, n):
            from pyspark.sql.functions import SkipRestOfInputTableException

            first = batch.slice(0, n[0].as_py() - self.held)
            if not first.num_rows:
                raise SkipRestOfInputTableException
            self.held += first.num_rows
            yield pa.Table.from_batches([first])

    register_table_function(session, name, FirstRows, FirstRowsOfBatches)


def _callable(df: DataFrame, function: str) -> str:
    """The name to call ``function`` by on ``df``: that of its form over batches, if it has one."""
    session = df.sparkSession
    batches = _batch_forms.get(_known_as(session, function))
    if batches is None:
        return function
    name = f"{function}_{uuid.uuid4().hex}"
    session.udtf.register(name, F.arrow_udtf(batches, returnType=df.schema))
    return name


def _dealt(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``df`` with the number of each row's part: a key has as many parts as its share of all rows calls for."""
    parts = partitions_for(df)
    number = F.monotonically_increasing_id()
    if not partition_by:
        return df.withColumn(_PART, F.pmod(number, F.lit(parts)))
    keys = {f"{_PART}_{at}": F.expr(key) for at, key in enumerate(partition_by)}
    sizes = df.select(*[key.alias(name) for name, key in keys.items()]).groupBy(*keys).agg(F.count("*").alias("_n"))
    whole = sizes.agg(F.sum("_n").alias("_all"))
    # Each holds more than one part's rows, so there are fewer of them than parts.
    large = sizes.crossJoin(F.broadcast(whole)).where(F.col("_n") * parts > F.col("_all"))
    large = large.select(*keys, F.ceil(F.col("_n") * parts / F.col("_all")).alias(f"{_PART}s"))
    keyed = df.withColumns(keys)
    same = functools.reduce(operator.and_, (keyed[name].eqNullSafe(large[name]) for name in keys))
    joined = keyed.join(F.broadcast(large), same, "left")
    return joined.select(*[keyed[name] for name in df.columns], F.pmod(number, F.coalesce(f"{_PART}s", F.lit(1))).alias(_PART))


def in_parts(
    df: DataFrame, function: str, partition_by: Sequence[str], order_by: Sequence[str], arguments: str = ""
) -> DataFrame:
    """``function(table(df) partition by … order by …, arguments)``, with the rows of a key dealt to many tasks first.

    It is for functions that give the same rows, in columns of the same names, for a key whether they are applied to all
    of its rows, or to what they give for parts of them. Their order must leave no ties. A key with more rows than
    one of the partitions that the input calls for is dealt to as many parts, so one with a third of all rows fills no
    task; all others are one part. The rows that the parts give meet in the second call. ``partition_by`` and ``order_by`` are
    SQL; ``arguments`` is put behind the table as it is.
    """
    if _PART in df.columns:
        raise ValueError(f"the name {_PART} is taken")
    order = f" order by ({', '.join(order_by)})"
    rest = f", {arguments}" if arguments else ""
    session = df.sparkSession
    parts = _dealt(df, partition_by)
    keys = ", ".join((*partition_by, _PART))
    called = _callable(parts, function)
    first = session.sql(f"select * from {called}(table({{parts}}) partition by ({keys}){order}{rest})", parts=parts)
    first = first.drop(_PART)
    keys = f"partition by ({', '.join(partition_by)})" if partition_by else "with single partition"
    called = _callable(first, function)
    return session.sql(f"select * from {called}(table({{first}}) {keys}{order}{rest})", first=first)
