"""Time limits, cancellation, further attempts, and scripts."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from slipway.operators.decode import submission_id
from slipway.operators.execute import JobRegistry
from slipway.operators.runner import Runner
from slipway.operators.sinks import read_result
from slipway.session import register_views

SLOW = "select sum(a.id % 7 * b.id) as s from range(0, 3000000, 1, 8) a join range(0, 3000000, 1, 8) b on a.id % 3 = b.id % 3"


@pytest.fixture
def jobs():
    registry, seen = JobRegistry(), []

    @registry.register("flaky")
    def flaky(session, arguments, environment):
        seen.append(arguments[0])
        if seen.count(arguments[0]) < int(arguments[1]):
            raise ConnectionError("lost")
        return session.range(3)

    registry.seen = seen
    return registry


def table(spark, *values):
    return spark.createDataFrame([(json.dumps(value),) for value in values], "value string")


def outcomes(status):
    return sorted((row.state, row.error_condition, row.error_message) for row in status.collect())


def test_a_time_limit_stops_and_keeps_what_was_there(spark, tmp_path):
    root = str(tmp_path / "r")
    Runner(root).run(table(spark, {"type": "SQL", "code": "select 1 as a", "resultsPath": "x", "resultFormat": "json"}))
    begun = time.monotonic()
    limited = Runner(root, time_limit=2)
    status = limited.run(
        table(
            spark,
            {"type": "SQL", "code": SLOW, "resultsPath": "x", "resultFormat": "json"},
            {"type": "SQL", "code": "select 2 as a", "resultsPath": "y", "resultFormat": "json"},
        )
    )
    assert time.monotonic() - begun < 60
    assert sorted((row.state, row.error_condition) for row in status.collect()) == [("CANCELLED", "TIME_LIMIT"), ("OK", None), ("OK", None)]
    assert [row.a for row in read_result(spark, f"{root}/x", "json").collect()] == [1]
    assert [row.a for row in read_result(spark, f"{root}/y", "json").collect()] == [2]


def test_cancelling_one_leaves_the_others(spark, tmp_path):
    runner = Runner(str(tmp_path / "r"))
    slow = json.dumps({"type": "SQL", "code": SLOW})
    values = spark.createDataFrame([(slow, None), (json.dumps({"type": "SQL", "code": "select 1 as a"}), None)], "value string, source_file string")
    name = values.where(F.col("value") == slow).select(submission_id(F.col("value"), F.col("source_file"))).first()[0]

    def cancel_when_it_runs():
        while name not in runner._watches:
            time.sleep(0.05)
        time.sleep(1)
        runner.cancel(name)

    asker = threading.Thread(target=cancel_when_it_runs)
    asker.start()
    status = runner.run(values)
    asker.join()
    assert {row.submission_id == name: (row.state, row.error_condition) for row in status.collect()} == {
        True: ("CANCELLED", "CANCELLED"), False: ("OK", None),
    }
    assert not list(spark.sparkContext.getJobTags()) and not runner._watches


def test_attempts(spark, tmp_path, jobs):
    runner = Runner(str(tmp_path / "r"), jobs=jobs, attempts=3, pause=0.01, pool_by="team")
    status = runner.run(
        table(
            spark,
            {"type": "PYTHON", "code": "flaky", "arguments": ["a", "3"], "environment": {"team": "one"}},
            {"type": "PYTHON", "code": "flaky", "arguments": ["b", "4"]},
            {"type": "SQL", "code": "select 1 / 0 as a"},
        )
    )
    found = outcomes(status)
    assert [row[:2] for row in found] == [("FAILED", "ConnectionError"), ("FAILED", "DIVIDE_BY_ZERO"), ("OK", None)]
    assert found[2][2] == "after 3 attempts"
    assert (jobs.seen.count("a"), jobs.seen.count("b")) == (3, 3)


def test_a_script_with_a_handler(spark, tmp_path, folder):
    script = """begin
      declare n bigint default 0;
      declare exit handler for divide_by_zero begin select -1 as n; end;
      while n < 3 do set n = n + 1; end while;
      if (select count(*) from nation) = 0 then select n / 0 as n; end if;
      select n + count(*) as n from nation;
    end"""
    failing = script.replace("= 0 then", "> 0 then")
    runner = Runner(str(tmp_path / "r"), lambda session: register_views(session, folder, ["nation"]))
    status = runner.run(
        table(
            spark,
            {"type": "SQL", "code": script, "resultsPath": "a", "resultFormat": "json"},
            {"type": "SQL", "code": failing, "resultsPath": "b", "resultFormat": "json"},
        )
    )
    assert {row.state for row in status.collect()} == {"OK"}
    assert read_result(spark, f"{runner.results_root}/a", "json").first().n == 28
    assert read_result(spark, f"{runner.results_root}/b", "json").first().n == -1
