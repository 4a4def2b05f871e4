"""Table functions that take a table: columns from the table, keys of any size."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from slipway import Runner, read_result
from slipway.functions import tables
from slipway.functions.tables import in_parts, register_first_rows


@pytest.fixture
def session(spark):
    session = spark.newSession()
    register_first_rows(session)
    return session


def rows(session):
    """Key 0 has a third of all rows, one key is null, one has a single row."""
    hot = session.range(3000).selectExpr("0 as k", "id as v", "concat('h', id) as name")
    rest = session.range(6000).selectExpr("if(id % 7 = 0, null, int(id % 7)) as k", "id as v", "concat('r', id) as name")
    return hot.union(rest).union(session.sql("select 99, 1L, 'only'")).repartition(5)


def expected(df, n):
    ranked = df.selectExpr("*", "row_number() over (partition by k order by v desc, name) as r")
    return sorted(map(tuple, ranked.where(F.col("r") <= n).drop("r").collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 5, 4000])
def test_first_rows(session, n):
    df = rows(session)
    found = in_parts(df, "first_rows", ["k"], ["v desc", "name"], str(n))
    assert found.schema.names == ["k", "v", "name"] and [f.dataType for f in found.schema] == [f.dataType for f in df.schema]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(df, n)


def test_no_key_takes_all_rows_as_one_partition(session):
    found = in_parts(rows(session), "first_rows", [], ["v desc", "name"], "2")
    assert sorted(found.collect(), key=repr) == sorted(rows(session).orderBy(F.desc("v"), "name").limit(2).collect(), key=repr)


def test_empty_table(session):
    assert in_parts(rows(session).limit(0), "first_rows", ["k"], ["v", "name"], "3").count() == 0


def test_columns_follow_from_the_table(session):
    session.range(10).selectExpr("id", "array(id) as list", "named_struct('a', id) as s").createOrReplaceTempView("t")
    found = session.sql("select * from first_rows(table(t) with single partition order by (id desc), 1)")
    assert found.schema.names == ["id", "list", "s"]
    assert [(row.id, row.list, row.s.a) for row in found.collect()] == [(9, [9], 9)]


@pytest.mark.parametrize("call", ["first_rows(table(t), -1)", "first_rows(table(t), 'x')", "first_rows(1, 1)"])
def test_wrong_arguments_fail_before_the_query_runs(session, call):
    session.range(3).createOrReplaceTempView("t")
    with pytest.raises(AnalysisException):
        session.sql(f"select * from {call}").schema


def test_a_frequent_key_is_dealt_to_many_tasks(session, tmp_path):
    session.conf.set("spark.slipway.partitionBytes", "4096")
    rows(session).write.parquet(str(tmp_path / "t"))
    df = session.read.parquet(str(tmp_path / "t"))
    plan = in_parts(df, "first_rows", ["k"], ["v desc", "name"], "3")._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan
    assert sorted(map(tuple, in_parts(df, "first_rows", ["k"], ["v desc", "name"], "3").collect()), key=repr) == expected(df, 3)


def test_only_frequent_keys_are_dealt(session, monkeypatch):
    """A key with fewer rows than a partition is one part, so its rows meet in the first call."""
    monkeypatch.setattr(tables, "partitions_for", lambda df: 10)
    few = session.range(3000).selectExpr("if(id % 500 = 0, null, int(id % 500)) as k")
    dealt = tables._dealt(few.union(session.range(1500).selectExpr("if(id < 1000, -1, null) as k")), ["k"])
    parts = {row.k: row.n for row in dealt.groupBy("k").agg(F.count_distinct("_part").alias("n")).collect()}
    assert {n for k, n in parts.items() if k is not None and k >= 0} == {1}
    assert parts[-1] == 3 and parts[None] == 2


def test_parts_are_called_over_batches(session):
    plan = in_parts(rows(session), "first_rows", ["k"], ["v desc", "name"], "3")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("ArrowEvalPythonUDTF") == 2


def test_columns_of_many_types_over_batches(session):
    session.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    df = session.range(20000).selectExpr(
        "concat('k', id % 3) as k", "id", "if(id % 2 = 0, null, cast(id as decimal(20, 3))) as d", "timestamp_seconds(id) as t",
        "date_add(date '2024-01-01', int(id % 99)) as day", "array(id, null) as list", "named_struct('a', id, 'b', 'x') as s",
        "map('m', id) as m", "to_binary(cast(id as string), 'utf-8') as bytes", "timestamp_ntz '2024-01-02 03:04:05.000001' as z",
    )
    found = in_parts(df, "first_rows", ["k", "id % 2"], ["id"], "3000")
    assert [f.dataType for f in found.schema] == [f.dataType for f in df.schema]
    ranked = df.withColumn("r", F.expr("row_number() over (partition by k, id % 2 order by id)")).where("r <= 3000").drop("r")
    assert sorted(found.collect(), key=lambda row: row.id) == sorted(ranked.collect(), key=lambda row: row.id)


def test_in_a_submission(spark, tmp_path):
    def setup(session):
        register_first_rows(session)
        session.range(20).selectExpr("id % 2 as k", "id as v").createOrReplaceTempView("t")

    runner = Runner(str(tmp_path), setup=setup)
    code = "select * from first_rows(table(t) partition by k order by (v), 2)"
    text = json.dumps({"type": "SQL", "code": code, "resultFormat": "parquet", "resultsPath": "first"})
    status = runner.run(spark.createDataFrame([(text,)], "value string")).collect()
    assert [row.state for row in status] == ["OK"], status
    assert sorted(map(tuple, read_result(spark, f"{tmp_path}/first", "parquet").collect())) == [(0, 0), (0, 2), (1, 1), (1, 3)]
