import base64
import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from slipway.operators.execute import JobRegistry
from slipway.operators.runner import Runner
from slipway.operators.sinks import read_result
from slipway.operators.status import STATUS_DDL
from slipway.session import register_views


def submission(**fields):
    return json.dumps(fields)


def submissions(spark, *values, source_file=None):
    return spark.createDataFrame([(value, source_file) for value in values], "value string, source_file string")


@pytest.fixture
def jobs():
    registry = JobRegistry()

    @registry.register("double")
    def double(session, arguments, environment):
        label = F.lit(environment.get("E")).alias("e")
        return session.range(int(arguments[0])).select((F.col("id") * 2).alias("v"), label)

    return registry


@pytest.fixture
def runner(tmp_path, folder, jobs):
    return Runner(str(tmp_path / "results"), lambda s: register_views(s, folder, ["orders", "nation"]), jobs)


def states(status):
    return {row.submission_id: row.state for row in status.collect()}


def test_every_outcome_is_recorded(spark, runner):
    values = {
        "OK": submission(type="SQL", code="select 1 as a", resultFormat="json", resultsPath="ok"),
        "DIVIDE_BY_ZERO": submission(type="SQL", code="select n_nationkey / 0 as a from nation", resultsPath="x"),
        "TABLE_OR_VIEW_NOT_FOUND": submission(type="SQL", code="select * from no_such_table"),
        "PARSE_SYNTAX_ERROR": submission(type="SQL", code="selec 1"),
        "LookupError": submission(type="PYTHON", code="print(1)"),
        "PermissionError": submission(type="SQL", code="select 1 as a", resultsPath="../x"),
        "DATA_SOURCE_NOT_FOUND": submission(type="SQL", code="select 1 as a", resultFormat="nope", resultsPath="y"),
        "UNSUPPORTED": submission(type="COMMAND", code="ls"),
        "UNKNOWN_FIELD": submission(type="SQL", resultPath="z"),
        "MALFORMED": "{bad",
    }
    status = runner.run(submissions(spark, *values.values()))
    rows = status.collect()
    assert len(rows) == len(values)
    found = {(r.error_condition or r.state): r for r in rows}
    assert found.keys() == values.keys()
    assert (found["OK"].state, found["OK"].response, found["OK"].type) == ("OK", "SQL code submitted", "SQL")
    assert found["OK"].results_path.endswith("/results/ok") and found["OK"].result_format == "json"
    assert found["OK"].started_at <= found["OK"].finished_at
    assert found["DIVIDE_BY_ZERO"].state == "FAILED" and "zero" in found["DIVIDE_BY_ZERO"].error_message
    assert found["DIVIDE_BY_ZERO"].response == "Failed to submit code"
    assert found["UNSUPPORTED"].response == "COMMAND code submitted"
    assert found["MALFORMED"].state == "REJECTED"
    assert found["MALFORMED"].response == "Failed to parse code submission"
    assert status.schema.simpleString() == spark.createDataFrame([], STATUS_DDL).schema.simpleString()
    assert read_result(spark, found["OK"].results_path, "json", "a int").collect() == [(1,)]


def test_arguments_reach_sql_and_jobs(spark, runner):
    runner.run(
        submissions(
            spark,
            submission(type="SQL", code="select cast(? as int) + 1 as v", arguments=["4"], resultsPath="sql"),
            submission(type="SQL", code="select 3 as v", arguments=["unused"], resultsPath="unused"),
            submission(type="PYTHON", code="double", arguments=["3"], environment={"E": "x"}, resultsPath="job"),
            submission(
                type="PYTHON_BASE64", code=base64.b64encode(b"double\n").decode(), arguments=["2"], resultsPath="job64"
            ),
        )
    )
    root = runner.results_root
    assert set(states(runner.status(spark)).values()) == {"OK"}
    assert read_result(spark, f"{root}/sql").collect() == [(5,)]
    assert read_result(spark, f"{root}/unused").collect() == [(3,)]
    assert sorted(read_result(spark, f"{root}/job").collect()) == [(0, "x"), (2, "x"), (4, "x")]
    assert read_result(spark, f"{root}/job64").count() == 2


def test_results_without_a_path_are_kept_as_text(spark, runner, table):
    code = "select n_nationkey, n_name from nation where n_nationkey < 2"
    values = {f: submission(type="SQL", code=code, resultFormat=f, resultsPath="") for f in ("json", "csv", "x")}
    values[None] = submission(type="SQL", code=code)
    status = {r.result_format: r for r in runner.run(submissions(spark, *values.values())).collect()}
    text = {f: sorted(r.value for r in spark.read.text(row.results_path).collect()) for f, row in status.items()}
    names = {r.n_nationkey: r.n_name for r in table("nation").collect()}
    assert text["csv"] == [f"0,{names[0]}", f"1,{names[1]}"]
    assert [json.loads(t) for t in text["json"]] == [{"n_nationkey": i, "n_name": names[i]} for i in (0, 1)]
    assert [json.loads(t) for t in text["x"]] == [[str(i), names[i]] for i in (0, 1)]
    assert text[None] == text["json"]


def test_a_second_delivery_is_not_run_again(spark, runner):
    value = submission(type="SQL", code="select current_timestamp() as t", resultsPath="t")
    first = runner.run(submissions(spark, value, value, value, source_file="f"))
    assert [(r.state, r.deliveries) for r in first.collect()] == [("OK", 3)]
    before = read_result(spark, f"{runner.results_root}/t").collect()
    again = runner.run(submissions(spark, value, "{bad", source_file="f"))
    assert sorted(r.state for r in again.collect()) == ["OK", "REJECTED"]
    assert read_result(spark, f"{runner.results_root}/t").collect() == before
    runner.run(submissions(spark, value, source_file="another file"))
    assert runner.status(spark).count() == 3
    assert read_result(spark, f"{runner.results_root}/t").collect() != before


def test_failure_keeps_the_old_result(spark, runner):
    ok = submission(type="SQL", code="select * from nation", resultsPath="n")
    bad = submission(type="SQL", code="select raise_error('x') as a from nation", resultsPath="n")
    runner.run(submissions(spark, ok))
    runner.run(submissions(spark, bad))
    assert sorted(states(runner.status(spark)).values()) == ["FAILED", "OK"]
    assert read_result(spark, f"{runner.results_root}/n").count() == 25


def test_many_submissions_run_side_by_side_and_apart(spark, tmp_path):
    running, most, lock = 0, 0, threading.Lock()
    jobs = JobRegistry()

    @jobs.register("own_view")
    def own_view(session, arguments, environment):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        session.range(int(arguments[0])).createOrReplaceTempView("mine")
        counted = session.sql("select count(*) as n from mine")
        counted.collect()
        with lock:
            running -= 1
        return counted

    runner = Runner(str(tmp_path / "r"), jobs=jobs, max_parallel=4, status_batch=5, pool="submissions")
    values = [submission(type="PYTHON", code="own_view", arguments=[str(i)], resultsPath=f"p{i}") for i in range(12)]
    status = runner.run(submissions(spark, *values).repartition(3))
    assert sorted(states(status).values()) == ["OK"] * 12
    assert 1 < most <= 4
    for i in (0, 5, 11):
        assert read_result(spark, f"{runner.results_root}/p{i}").first().n == i


def test_session_settings(spark, tmp_path):
    runner = Runner(str(tmp_path / "r"), session_conf={"spark.sql.ansi.enabled": "false"})
    runner.run(submissions(spark, submission(type="SQL", code="select 1 / 0 as a", resultsPath="x")))
    assert read_result(spark, f"{runner.results_root}/x").first().a is None


def test_nothing_to_run(spark, runner):
    assert runner.run(submissions(spark).limit(0)).count() == 0
    assert runner.status(spark).count() == 0


def test_statement_without_a_result(spark, runner):
    code = "create or replace temporary view v as select 1 as a"
    rows = runner.run(
        submissions(
            spark,
            submission(type="SQL", code=code),
            submission(type="SQL", code=code, resultFormat="csv"),
            submission(type="SQL", code=code, resultFormat="x"),
            submission(type="SQL", code=code, resultPath="no such field"),
        )
    ).collect()
    assert sorted(r.state for r in rows) == ["OK", "OK", "OK", "REJECTED"]
    assert all(spark.read.text(r.results_path).count() == 0 for r in rows if r.state == "OK")


def test_statement_without_a_result_but_with_a_path(spark, runner, tmp_path):
    codes = [
        f"create table made_here using parquet location '{tmp_path}/made' as select 1 as a",
        f"insert overwrite directory '{tmp_path}/put' using parquet select 2 as a",
    ]
    found = runner.run(submissions(spark, *(submission(type="SQL", code=c, resultsPath="p") for c in codes))).collect()
    try:
        assert [(row.state, row.results_path) for row in found] == [("OK", None)] * 2
        assert spark.read.parquet(f"{tmp_path}/put").collect() == [(2,)]
    finally:
        spark.sql("drop table if exists made_here")


def test_submission_that_names_an_unknown_database(spark, runner):
    (row,) = runner.run(submissions(spark, submission(type="SQL", code="select * from a.b.c.d"))).collect()
    assert row.state == "FAILED" and row.error_condition and row.error_message


def test_runs_may_share_a_status_table(spark, runner):
    def deliver(i):
        good = submission(type="SQL", code=f"select {i} as a", resultsPath=f"p{i}")
        runner.run(submissions(spark, good, "{bad", source_file=f"f{i}"))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(deliver, range(8)))
    rows = runner.status(spark).collect()
    assert sorted(r.state for r in rows) == ["OK"] * 8 + ["REJECTED"] * 8
    assert len({r.submission_id for r in rows}) == 16


def test_answers_come_in_the_order_of_the_query(spark, runner, table):
    code = "select o_orderkey from orders order by o_orderkey desc"
    texts = [submission(type="SQL", code=code, resultFormat=name) for name in ("json", "csv", "rows")]
    status = runner.run(submissions(spark, *texts)).collect()
    expected = [row.o_orderkey for row in table("orders").orderBy(F.desc("o_orderkey")).collect()]
    for row in status:
        body = "".join(runner.answer(spark, row.submission_id))
        if row.result_format == "csv":
            assert body == "\n".join(map(str, expected))
        elif row.result_format == "json":
            assert [json.loads(text)["o_orderkey"] for text in json.loads(body)] == expected
        else:
            assert json.loads(body) == [[str(key)] for key in expected]
    with pytest.raises(LookupError):
        runner.answer(spark, "unknown")
