import json

import pytest
from pyspark.sql import functions as F

from slipway.operators.decode import (
    base64_text, decode_submissions, key_value_map, notebook_requests, rejected_submissions, route_submissions,
    valid_submissions,
)
from slipway.sources.submissions import read_submissions

CASES = [
    ('{"type":"SQL","code":"select 1"}', None),
    ('{"type":"SQL","environment":{"A":1}}', None),
    ('{"type":"SQL","code":"select appId from t"}', None),
    ('{"type":"SQL","code":"a","code":"b"}', None),
    ('{"type":"SQL"} trailing', None),
    ('{"type":"SQL","code":5,"arguments":[1,"b"],"environment":{}}', None),
    ('{"type":"SQL","code":null,"arguments":null,"environment":null}', None),
    ('{"type":"SQL","code":"OBJECT<a: ARRAY<b>>","environment":{"arguments":"x"}}', None),
    ('{"type":"SQL","code":"{a"}', None),
    ('{"type":"sql","code":"x"}', "UNKNOWN_TYPE"),
    ('{"type":5,"code":"x"}', "UNKNOWN_TYPE"),
    ('{"type":"SQL","code":"a","code":{"b":1}}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","code":{"b":1,"b":2}}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","code":"a","arguments":[["q"]],"arguments":[["q"]]}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","arguments":[{"b":1,"b":2}]}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","environment":{"k":{"a":1,"a":1}}}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","code":"a","arguments":["[q"],"environment":{"k":"{a"}}', None),
    ("{}", "UNKNOWN_TYPE"),
    ('{"type":"SQL","resultPath":"p"}', "UNKNOWN_FIELD"),
    ('{"type":"SQL","arguments":"a"}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","environment":["a"]}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","code":{"a":1}}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","code":["a"]}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","arguments":[["a"]]}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","arguments":["a",{"b":1}]}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","environment":{"a":{"b":1}}}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","environment":{"arguments":["b"]}}', "BAD_FIELD_TYPE"),
    ('{"type":"SQL","environment":{"a":"b"},"resultsPath":{"c":"d"}}', "BAD_FIELD_TYPE"),
    ("{bad", "MALFORMED"),
    ("[1]", "MALFORMED"),
    ("null", "MALFORMED"),
    ('"s"', "MALFORMED"),
    ("", "MALFORMED"),
    (None, "MALFORMED"),
    ('{"appId":"a","configOverrides":{"arguments":["--x","1"]}}', "NOTEBOOK"),
]


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(i, value) for i, (value, _) in enumerate(CASES)]
    return decode_submissions(spark.createDataFrame(rows, "i int, value string"))


def test_reasons(decoded):
    found = {row.i: row.reason for row in decoded.collect()}
    assert [(value, found[i]) for i, (value, _) in enumerate(CASES)] == CASES


def test_values(decoded):
    rows = {row.i: row for row in valid_submissions(decoded).collect()}
    assert rows[1].environment == {"A": "1"}
    assert rows[2].code == "select appId from t"
    assert rows[3].code == "b"
    assert (rows[5].code, rows[5].arguments) == ("5", ["1", "b"])
    assert (rows[6].code, rows[6].arguments, rows[6].environment) == (None, None, None)


def test_every_row_is_valid_or_rejected(decoded):
    valid, rejected = valid_submissions(decoded), rejected_submissions(decoded)
    assert valid.count() + rejected.count() == len(CASES)
    assert rejected.columns == ["i", "value", "reason"]


def test_record_survives_a_round_trip(spark):
    record = {
        "type": "SQL", "code": 'select "a", \'b\'\n', "className": "", "arguments": ["x", ""],
        "environment": {"K": "v"}, "config": "", "resultFormat": "csv", "resultsPath": "test.csv",
    }
    df = decode_submissions(spark.createDataFrame([(json.dumps(record),)], "value string"))
    again = valid_submissions(df).select(F.to_json(F.struct(*record)).alias("value"))
    assert json.loads(again.first().value) == record


def test_parsing_is_done_once_even_below_a_filter(spark, decoded):
    plan = valid_submissions(decoded)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_notebook_arguments(spark):
    bodies = [
        '{"appId":"a","configOverrides":{"arguments":["--x","1"]}}',
        '{"appId":"a","configOverrides":{"arguments":"--x"}}',
        '{"appId":"a","configOverrides":{"arguments":"[1]"}}',
        '{"appId":"a","configOverrides":{}}',
        '{"appId":"a"}',
        '{"type":"SQL","code":"appId"}',
    ]
    df = spark.createDataFrame([(i, body) for i, body in enumerate(bodies)], "i int, value string")
    found = {row.i: row.launch_arguments for row in notebook_requests(decode_submissions(df)).collect()}
    assert found == {0: ["--x", "1"], 1: None, 2: None, 3: None, 4: None}


def test_routes(spark):
    types = ["SQL", "PYTHON", "PYTHON_BASE64", "PYTHON_FILE", "JAVA", "R", "COMMAND"]
    rows = [(json.dumps({"type": t, "code": "YWI=", "resultsPath": p}),) for t in types for p in (None, "", "x")]
    routed = route_submissions(valid_submissions(decode_submissions(spark.createDataFrame(rows, "value string"))))
    rows = routed.collect()
    assert {(r.type, r.route) for r in rows} == {
        ("SQL", "sql"), ("PYTHON", "job"), ("PYTHON_BASE64", "job"), ("PYTHON_FILE", "unsupported"),
        ("JAVA", "unsupported"), ("R", "unsupported"), ("COMMAND", "unsupported"),
    }
    assert {r.resultsPath: r.inline for r in rows} == {None: True, "": True, "x": False}
    assert {r.program for r in rows if r.type == "PYTHON_BASE64"} == {"ab"}
    assert {r.program for r in rows if r.type != "PYTHON_BASE64"} == {"YWI="}


def test_base64(spark):
    df = spark.createDataFrame([("YWI=",), ("!!",), ("",), (None,), ("w7w=",)], "code string")
    assert [r.t for r in df.select(base64_text(F.col("code")).alias("t")).collect()] == ["ab", None, "", None, "ü"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a=1=2,b,a=3,,=z", {"a": "3", "": "z"}),
        ("", {}),
        (None, None),
        ("a=", {"a": ""}),
        ("a,b", {}),
        (" a = 1 ,b=2", {" a ": " 1 ", "b": "2"}),
    ],
)
def test_key_value_map(spark, text, expected):
    df = spark.createDataFrame([(text,)], "h string")
    assert df.select(key_value_map(F.col("h")).alias("m")).first().m == expected


def test_read_submissions(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text('{"type":"SQL"}\n{"type":"R"}\n')
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "b.json").write_text('{\n"type":\n"SQL"}\n')
    lines = read_submissions(spark, str(tmp_path / "lines"))
    assert lines.count() == 2
    assert {r.source_file.rsplit("/", 1)[1] for r in lines.collect()} == {"a.json"}
    whole = valid_submissions(decode_submissions(read_submissions(spark, str(tmp_path / "whole"), whole_files=True)))
    assert [r.type for r in whole.collect()] == ["SQL"]
