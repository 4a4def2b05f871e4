import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from slipway.operators.render import (
    columns_document, inline_body, render, render_columns, render_csv, render_json, render_rows,
)

ONE_OF_EACH = """
select true as bool, 1 as i, 1.5d as d, cast(1.5 as decimal(5, 2)) as dec, 'a,"b' as s, date '2024-01-02' as day,
       timestamp_ntz '2024-01-02 03:04:05.123456' as t, array(1, null) as a, map('k', 1) as m,
       named_struct('x', 1, 'y', cast(null as int)) as st, cast(null as string) as n, cast('ab' as binary) as b
"""


def texts(df):
    return [row.value for row in df.collect()]


def test_json(spark):
    assert texts(render_json(spark.sql(ONE_OF_EACH))) == [
        '{"bool":true,"i":1,"d":1.5,"dec":1.50,"s":"a,\\"b","day":"2024-01-02","t":"2024-01-02T03:04:05.123456",'
        '"a":[1,null],"m":{"k":1},"st":{"x":1},"b":"YWI="}'
    ]


def test_csv(spark):
    scalars = spark.sql(ONE_OF_EACH).select("bool", "i", "d", "dec", "s", "day", "n")
    assert texts(render_csv(scalars)) == ['true,1,1.5,1.50,"a,\\"b",2024-01-02,']


def test_csv_keeps_microseconds_and_padding(spark):
    padded = spark.sql("select timestamp_ntz '2024-01-02 03:04:05.123456' as t, ' p ' as s")
    assert texts(render_csv(padded)) == ["2024-01-02T03:04:05.123456, p "]


def test_rows(spark):
    scalars = spark.sql(ONE_OF_EACH).select("bool", "i", "s", "n", "day")
    assert texts(render_rows(scalars)) == ['["true","1","a,\\"b",null,"2024-01-02"]']


def test_equal_names_and_no_rows(spark):
    twice = spark.sql("select 1 as a, 2 as a")
    assert texts(render_json(twice)) == ['{"a":1,"a":2}']
    assert texts(render_rows(twice)) == ['["1","2"]']
    assert texts(render_csv(twice)) == ["1,2"]
    assert texts(render_json(twice.limit(0))) == []


def test_statement_without_columns(spark):
    nothing = spark.sql("set spark.sql.x.y=1").select()
    for name in (None, "json", "csv", "other"):
        assert render(nothing.limit(0), name).columns == ["value"]


def body(pieces):
    return "".join(pieces)


def test_inline_body(spark):
    df = spark.range(2).select("id", F.lit("ü").alias("s"))
    assert json.loads(body(inline_body(df))) == ['{"id":0,"s":"ü"}', '{"id":1,"s":"ü"}']
    assert body(inline_body(df, None)) == body(inline_body(df, "json"))
    assert body(inline_body(df, "csv")) == "0,ü\n1,ü"
    assert json.loads(body(inline_body(df, "rows"))) == [["0", "ü"], ["1", "ü"]]
    assert body(inline_body(df.limit(0))) == "[]"
    assert body(inline_body(df.limit(0), "csv")) == ""


def test_bodies_are_whole_and_come_in_small_pieces(spark):
    df = spark.range(25_000)
    pieces = [*inline_body(df, "rows")]
    assert max(map(len, pieces)) < 20
    assert json.loads(body(pieces)) == [[str(i)] for i in range(25_000)]
    pieces = [*columns_document(df, ["id"])]
    assert max(map(len, pieces)) < 20_000
    assert json.loads(body(pieces)) == {"id": {str(i): i for i in range(25_000)}}
    assert json.loads(body(columns_document(df.select("id", F.lit(1).alias("x")).limit(0), ["id"]))) == {"id": {}, "x": {}}


def test_columns_document_is_what_a_data_frame_writes(spark):
    rows = [
        (3, "a/\"b", 1.5, datetime(2024, 1, 2, 3, 4, 5, 123456), True, date(1969, 12, 31)),
        (1, None, None, None, None, None),
        (2, "", float("nan"), datetime(1969, 12, 31, 23, 59, 59), False, date(2024, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "k int, s string, d double, t timestamp_ntz, b boolean, day date")
    expected = json.loads(df.orderBy("k").toPandas().to_json())
    assert json.loads(body(columns_document(df, ["k"]))) == expected


def test_columns_with_a_session_time_zone(spark):
    df = spark.sql("select 1 as k, timestamp '2024-01-02 03:04:05.678Z' as t, cast(1.25 as decimal(5, 2)) as d")
    assert json.loads(body(columns_document(df, ["k"]))) == {
        "k": {"0": 1}, "t": {"0": 1704164645678}, "d": {"0": 1.25},
    }
    assert df.first().d == Decimal("1.25")


def test_columns_come_in_pieces_of_bounded_size(spark):
    df = spark.range(2500).select((2499 - F.col("id")).alias("k"), F.col("id").alias("odd `name`"))
    pieces = render_columns(df.repartition(7), ["k"], chunk_rows=1000).collect()
    assert sorted((p["column"], p.chunk) for p in pieces) == [(c, i) for c in ("k", "odd `name`") for i in range(3)]
    merged = {}
    for p in pieces:
        part = json.loads(p.value)
        assert len(part) == (500 if p.chunk == 2 else 1000)
        merged.setdefault(p["column"], {}).update(part)
    assert merged["k"] == {str(i): i for i in range(2500)}
    assert merged["odd `name`"] == {str(i): 2499 - i for i in range(2500)}


def test_columns_need_unique_names(spark):
    with pytest.raises(ValueError):
        render_columns(spark.sql("select 1 as a, 2 as a"), ["a"])
