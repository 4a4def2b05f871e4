import os

import pytest
from pyspark.sql import functions as F

from conftest import TABLES
from slipway.operators.sinks import (
    CONNECTION_DDL, ROWS_PER_FILE, literal_rows, publish_connections, publish_global_view, read_result, resolve_path,
    write_result,
)
from slipway.session import open_session

TRICKY = [
    (1, ""), (2, None), (3, " x "), (4, 'a"b'), (5, "l1\nl2"), (6, '"'), (7, "a\\"), (8, ","),
    (9, "\r\n"), (10, " "), (11, "<a>&amp;"), (12, "\n"),
    (13, "\\N"), (14, '""'), (15, "null"), (16, "#c"), (17, "\r"), (18, "a\r\nb\rc\n"), (19, "\x00"),
]


def assert_same(a, b):
    assert a.exceptAll(b).isEmpty()
    assert b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("result_format", ["csv", "json", "orc", "parquet", None])
@pytest.mark.parametrize("name", TABLES)
def test_round_trip(spark, table, tmp_path, name, result_format):
    if name == "embeddings" and result_format == "csv":
        pytest.skip("CSV has no arrays")
    source, path = table(name), str(tmp_path / "out")
    write_result(source, path, result_format)
    assert_same(source, read_result(spark, path, result_format, source.schema))


@pytest.mark.parametrize("result_format", ["csv", "json", "orc", "parquet", "xml"])
def test_tricky_text(spark, tmp_path, result_format):
    # XML has no way to write the character NUL.
    rows = [row for row in TRICKY if (row[1], result_format) != ("\x00", "xml")]
    df = spark.createDataFrame(rows, "i int, s string")
    # In one file, and each row in a file of its own.
    for parts in (1, len(TRICKY)):
        write_result(df.repartition(parts), str(tmp_path / "out"), result_format)
        assert_same(df, read_result(spark, str(tmp_path / "out"), result_format, df.schema))


@pytest.mark.parametrize("result_format", ["csv", "json", "orc", "parquet", "xml"])
def test_tricky_text_alone(spark, tmp_path, result_format):
    rows = [(s,) for _, s in TRICKY if (s, result_format) not in (("\\N", "csv"), ("\x00", "xml"))]
    df = spark.createDataFrame(rows, "s string")
    write_result(df, str(tmp_path / "out"), result_format)
    assert_same(df, read_result(spark, str(tmp_path / "out"), result_format, df.schema))


@pytest.mark.parametrize("result_format", ["csv", "json", "orc", "parquet", "xml"])
def test_missing_values(spark, tmp_path, result_format):
    rows = [(None, None, None), (1, None, ""), (None, 2.5, None), (3, 4.5, "x")]
    df = spark.createDataFrame(rows, "i int, d double, s string")
    write_result(df, str(tmp_path / "out"), result_format)
    assert_same(df, read_result(spark, str(tmp_path / "out"), result_format, "i int, d double, s string"))


@pytest.mark.parametrize("result_format", ["csv", "xml"])
def test_files_that_a_task_reads_whole_are_bounded(spark, tmp_path, result_format):
    """One task writes all rows; as many tasks as there are files may read them."""
    df = spark.range(2 * ROWS_PER_FILE + 1).selectExpr("id", "concat('a', chr(10), id) as s").coalesce(1)
    write_result(df, str(tmp_path / "out"), result_format)
    back = read_result(spark, str(tmp_path / "out"), result_format, df.schema)
    assert [row.n for row in back.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).orderBy("n").collect()] == [
        1, ROWS_PER_FILE, ROWS_PER_FILE,
    ]
    assert_same(df, back)


@pytest.mark.parametrize("result_format", ["csv", "json", "orc", "parquet"])
def test_microseconds(spark, tmp_path, result_format):
    df = spark.sql(
        "select timestamp '2024-01-02 03:04:05.123456' as a, timestamp_ntz '2024-01-02 03:04:05.000001' as b"
    )
    write_result(df, str(tmp_path / "out"), result_format)
    assert_same(df, read_result(spark, str(tmp_path / "out"), result_format, df.schema))


def test_text_takes_one_string_column(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("",), ("b c",)], "value string")
    write_result(df, str(tmp_path / "out"), "text")
    assert_same(df, read_result(spark, str(tmp_path / "out"), "text"))


def test_result_that_parses_as_a_number(spark, tmp_path):
    write_result(spark.sql("select random() as r"), str(tmp_path / "test.csv"), "csv")
    files = [name for name in os.listdir(tmp_path / "test.csv") if name.endswith("csv")]
    assert files
    back = read_result(spark, str(tmp_path / "test.csv"), "csv", "v string")
    assert 0 <= back.select(F.expr("try_cast(v as double)").alias("v")).first().v < 1


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    write_result(spark.range(3), path)
    write_result(spark.range(5), path)
    assert read_result(spark, path).count() == 5
    assert os.listdir(tmp_path) == ["out"]


@pytest.mark.parametrize("bad", ["select raise_error('x') as id", "select 1 / id as id from range(0, 9, 1, 4)"])
def test_failed_run_leaves_the_old_result(spark, tmp_path, bad):
    path = str(tmp_path / "out")
    write_result(spark.range(3), path)
    with pytest.raises(Exception):
        write_result(spark.sql(bad), path)
    assert read_result(spark, path).count() == 3
    assert os.listdir(tmp_path) == ["out"]


def test_query_may_overwrite_what_it_reads(spark, tmp_path):
    path = str(tmp_path / "out")
    write_result(spark.range(3), path)
    write_result(read_result(spark, path).select(F.col("id") + 10), path)
    assert sorted(r[0] for r in read_result(spark, path).collect()) == [10, 11, 12]


def test_swap_that_was_cut_off_is_undone(spark, tmp_path):
    path = tmp_path / "out"
    write_result(spark.range(3), str(path))
    path.rename(tmp_path / ".out._old")
    assert read_result(spark, str(path)).count() == 3
    path.rename(tmp_path / ".out._old")
    with pytest.raises(Exception):
        write_result(spark.sql("select raise_error('x') as id"), str(path))
    assert read_result(spark, str(path)).count() == 3


def test_unknown_format(spark, tmp_path):
    with pytest.raises(Exception):
        write_result(spark.range(1), str(tmp_path / "out"), "no_such_format")
    assert os.listdir(tmp_path) == []


def test_paths_stay_below_the_root(spark, tmp_path):
    root = str(tmp_path)
    assert resolve_path(spark, root, "a/b").endswith(f"{root}/a/b")
    assert resolve_path(spark, root, f"{root}/a").endswith(f"{root}/a")
    assert resolve_path(spark, root, f"file:{root}/a").endswith(f"{root}/a")
    for path in ("../x", "a/../../x", "/etc/x", root, root + "x/a", "_status", "_inline/x", "a/.b", "file:/etc/x"):
        with pytest.raises(PermissionError):
            resolve_path(spark, root, path)


def test_connection_table(spark, tmp_path):
    path = str(tmp_path / "info")
    publish_connections(spark, [("py4j", 1234, "s1"), ("rbackend", 5678, "s2")], path)
    expected = [("py4j", 1234, "s1"), ("rbackend", 5678, "s2")]
    assert sorted(open_session(spark).table("global_temp.spark_connect_info").collect()) == expected
    assert sorted(read_result(spark, path).collect()) == expected
    with pytest.raises(Exception):
        literal_rows(spark, [("py4j", "no port", "s")], CONNECTION_DDL)


def test_global_view_is_seen_by_all_sessions(spark):
    publish_global_view(spark.range(3), "three")
    assert open_session(spark).sql("select count(*) as n from global_temp.three").first().n == 3
