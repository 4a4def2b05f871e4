"""Arguments with types, by place and by name, and programs named by class."""

import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from slipway.operators.execute import JobRegistry, run_sql
from slipway.operators.parameters import bindings
from slipway.operators.runner import Runner
from slipway.operators.sinks import read_result


def value_of(spark, value):
    args = bindings(spark, json.dumps({"parameters": {"v": value}}), None)
    return run_sql(spark, "select :v as v", args).first().v


@pytest.mark.parametrize(
    "value, expected",
    [
        (5, 5), (2**40, 2**40), (1.25, Decimal("1.25")), (True, True), ("it's", "it's"), (["a", "b"], ["a", "b"]), ([[1], [2, 3]], [[1], [2, 3]]),
        ({"type": "date", "value": "2024-02-29"}, date(2024, 2, 29)),
        ({"type": "array<date>", "value": ["2024-02-29", "2024-03-01"]}, [date(2024, 2, 29), date(2024, 3, 1)]),
        ({"type": "decimal(20,4)", "value": 1.5}, Decimal("1.5")), ({"type": "string", "value": "5"}, "5"), ({"type": "double", "value": 2}, 2.0),
        ({"type": "timestamp", "value": "2024-01-02T03:04:05.000006Z"}, datetime(2024, 1, 2, 3, 4, 5, 6, timezone.utc)),
        ({"type": "int", "value": None}, None),
    ],
)
def test_types(spark, value, expected):
    found = value_of(spark, value)
    assert (found.astimezone(timezone.utc) if isinstance(found, datetime) else found) == expected and type(found) is type(expected)


def test_structs(spark):
    assert value_of(spark, {"a": 1, "b": ["x"]}).asDict() == {"a": 1, "b": ["x"]}
    assert value_of(spark, {"type": "struct<a: int, b: date>", "value": {"a": 1, "b": "2024-01-01"}}) == (1, date(2024, 1, 1))


@pytest.mark.parametrize("value", [{"type": "date", "value": "no day"}, {"type": "int", "value": "x"}, {"type": "int, w string", "value": 1}, {"type": "nope", "value": 1}])
def test_values_that_do_not_fit(spark, value):
    with pytest.raises(Exception):
        value_of(spark, value)


@pytest.mark.parametrize("config", [None, "", "text", "[1]", "{}", '{"other": 1}'])
def test_without_parameters_the_arguments_are_bound(spark, config):
    assert bindings(spark, config, ["a"]) == ["a"] and bindings(spark, config, []) is None and bindings(spark, config, None) is None


def test_values_are_never_text(spark):
    assert run_sql(spark, "select :v = 'F' as same", bindings(spark, json.dumps({"parameters": {"v": "F' or '1'='1"}}), None)).first().same is False
    with pytest.raises(ValueError):
        bindings(spark, '{"parameters": 5}', None)


def test_submissions_with_parameters_and_classes(spark, tmp_path):
    jobs = JobRegistry()
    jobs.register("org.example.Twice")(lambda session, arguments, environment: session.range(int(arguments[0])).select((F.col("id") * 2).alias("v")))
    runner = Runner(str(tmp_path / "results"), jobs=jobs)

    def text(**fields):
        return json.dumps(fields)

    values = [
        text(type="SQL", code="select id from range(9) where id > ? order by id limit ?", config=json.dumps({"parameters": [3, 2]}), resultsPath="place"),
        text(type="SQL", code="select id from range(9) where array_contains(:ids, id) limit :n", arguments=["unused"], config=json.dumps({"parameters": {"ids": {"type": "array<bigint>", "value": [1, 7, 77]}, "n": 5}}), resultsPath="name"),
        text(type="SQL", code="select :d as d", config=json.dumps({"parameters": {"d": {"type": "date", "value": "x"}}}), resultsPath="bad"),
        text(type="JAVA", className="org.example.Twice", arguments=["3"], resultsPath="class"),
        text(type="JAVA", className="org.example.None", resultsPath="none"),
        text(type="JAVA", code="class X {}"),
    ]
    status = runner.run(spark.createDataFrame([(value,) for value in values], "value string")).collect()
    assert sorted((row.state, row.error_condition) for row in status if row.state != "OK") == [("FAILED", "LookupError"), ("FAILED", "ValueError"), ("UNSUPPORTED", None)]
    root = runner.results_root
    assert sorted(read_result(spark, f"{root}/place").collect()) == [(4,), (5,)]
    assert sorted(read_result(spark, f"{root}/name").collect()) == [(1,), (7,)]
    assert sorted(read_result(spark, f"{root}/class").collect()) == [(0,), (2,), (4,)]
