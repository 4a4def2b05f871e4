"""Render results as text. Each renderer gives one string column, built where the rows are."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.functions.columns import column
from slipway.operators.positions import with_row_index
from slipway.operators.sinks import MICROSECONDS, PADDING


def render_json(df: DataFrame) -> DataFrame:
    """One JSON object per row; null fields are left out, times have microseconds."""
    return df.select(F.to_json(F.struct("*"), MICROSECONDS).alias("value"))


def render_csv(df: DataFrame) -> DataFrame:
    """One CSV line per row, with microseconds and with the spaces around texts."""
    return df.select(F.to_csv(F.struct("*"), {**MICROSECONDS, **PADDING}).alias("value"))


def render_rows(df: DataFrame) -> DataFrame:
    """One JSON array of texts per row, nulls kept."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(F.to_json(F.array(*[F.col(name).cast("string") for name in plain.columns])).alias("value"))


def _json_value(value: Column) -> Column:
    """The JSON text of one value: that of a one-element array without its brackets."""
    array = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(array, F.lit(2), F.length(array) - 2)


def render_columns(df: DataFrame, order_by: Sequence[str | Column], chunk_rows: int = 1000) -> DataFrame:
    """Column-oriented JSON, ``{"0": v, "1": v, …}`` per column, with rows numbered in the order of ``order_by``.

    A column's text grows with the table, so it comes in pieces: each row of the result holds the entries of
    ``chunk_rows`` consecutive rows of one column as an object. `columns_document` puts them together.
    """
    if len(set(df.columns)) != len(df.columns):
        raise ValueError("column names must be unique")
    indexed = with_row_index(df, order_by, "_row")
    values = [_json_value(_column_value(name, kind)).alias(f"_{i}") for i, (name, kind) in enumerate(df.dtypes)]
    chunks = (
        indexed.select("_row", *values)
        .groupBy(F.expr(f"_row div {int(chunk_rows)}").alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("_row", *[f"_{i}" for i in range(len(values))]))).alias("rows"))
    )

    def entries(i: int) -> Column:
        pairs = F.transform("rows", lambda row: F.concat(F.lit('"'), row["_row"], F.lit('":'), row[f"_{i}"]))
        return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))

    pieces = [F.struct(F.lit(name).alias("column"), entries(i).alias("value")) for i, name in enumerate(df.columns)]
    return chunks.select("chunk", F.inline(F.array(*pieces))).select("column", "chunk", "value")


def _column_value(name: str, kind: str) -> Column:
    """What column-oriented JSON holds for a value: milliseconds since 1970 for a time, null for what is no number."""
    value = column(name)
    if kind in ("timestamp", "timestamp_ntz", "date"):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz") if kind != "timestamp" else F.timestamp_seconds(F.lit(0))
        return F.timestamp_diff("MILLISECOND", epoch, value)
    if kind in ("float", "double"):
        return F.when(F.abs(value) < float("inf"), value)
    return value


def render(df: DataFrame, result_format: str | None) -> DataFrame:
    """Render by the name a submission gives; no name means JSON."""
    if result_format is None or result_format == "json":
        return render_json(df)
    if result_format == "csv":
        return render_csv(df)
    return render_rows(df)


def body_of(rows: Iterable[str], result_format: str | None) -> Iterator[str]:
    """The body of one answer from rendered rows, in pieces, of which none is longer than a row and its separator.

    JSON results are an array of JSON texts, CSV results are lines, all others an array of arrays.
    """
    as_lines, as_texts = result_format == "csv", result_format is None or result_format == "json"
    if not as_lines:
        yield "["
    between = ""
    for row in rows:
        yield between + (json.dumps(row, ensure_ascii=False) if as_texts else row)
        between = "\n" if as_lines else ","
    if not as_lines:
        yield "]"


def inline_body(df: DataFrame, result_format: str | None = "json") -> Iterator[str]:
    """``df`` as the body of one answer, in pieces, see `body_of`. The driver holds one partition at a time."""
    return body_of((row.value for row in render(df, result_format).toLocalIterator()), result_format)


def columns_document(df: DataFrame, order_by: Sequence[str | Column]) -> Iterator[str]:
    """``df`` as one column-oriented JSON document, in pieces; the query runs once, the driver holds one partition."""
    places = F.create_map(*(F.lit(item) for place, name in enumerate(df.columns) for item in (name, place)))
    pieces = render_columns(df, order_by).withColumn("place", F.element_at(places, F.col("column")))
    here = -1
    yield "{"
    for piece in pieces.orderBy("place", "chunk").toLocalIterator():
        if piece["place"] != here:
            here = piece["place"]
            yield f'{"" if here == 0 else "},"}{json.dumps(piece["column"])}:{{'
        else:
            yield ","
        yield piece["value"][1:-1]
    if here < 0:
        yield ",".join(f"{json.dumps(name)}:{{}}" for name in df.columns) + "}"
    else:
        yield "}}"
