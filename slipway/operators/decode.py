"""Decode, check and route submissions. Everything here is a column expression, run where the rows are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.functions.columns import quoted

# The fields of a submission and the names its type may have.
SUBMISSION_DDL = (
    "type string, code string, className string, arguments array<string>, environment map<string,string>, "
    "config string, resultFormat string, resultsPath string"
)
SUBMISSION_FIELDS = (
    "type", "code", "className", "arguments", "environment", "config", "resultFormat", "resultsPath",
)
SUBMISSION_TYPES = ("PYTHON", "PYTHON_BASE64", "PYTHON_FILE", "JAVA", "R", "SQL", "COMMAND")

_JOB_TYPES = ("PYTHON", "PYTHON_BASE64")
_CORRUPT = "_corrupt"


def submission_id(value: Column, source_file: Column) -> Column:
    """Identity of a submission: its text and the file that delivered it."""
    return F.sha2(F.concat_ws("\n", F.coalesce(source_file, F.lit("")), F.coalesce(value, F.lit(""))), 256)


_TEXT_FIELDS = tuple(name for name in SUBMISSION_FIELDS if name not in ("arguments", "environment"))

_KEY_FAULT = f"""
case when _keys is null then 'MALFORMED'
     when array_contains(_keys, 'appId') then 'NOTEBOOK'
     when size(array_except(_keys, array{SUBMISSION_FIELDS})) > 0 then 'UNKNOWN_FIELD' end
"""

# True if a field that takes text, or an element of `arguments` or `environment`, is an object or array. Such a value
# decodes to its JSON text, so only submissions with a value that begins like one are looked at again. If such a
# submission also repeats a key, which no variant can hold, its values' kinds cannot be told and it is rejected.
_SUSPECT = rf"""
coalesce({" or ".join(f"left(_record.{name}, 1) in ('[', '{{')" for name in _TEXT_FIELDS)}, false)
or concat_ws('\n', '', _record.arguments, map_values(_record.environment)) rlike '\\n[\\[{{]'
"""
_NESTED = """
try_parse_json({value}) is null or exists(
  concat(array({text}),
         coalesce(try_variant_get(try_parse_json({value}), '$.arguments', 'array<variant>'), array()),
         coalesce(map_values(try_variant_get(try_parse_json({value}), '$.environment', 'map<string,variant>')),
                  array())),
  part -> coalesce(schema_of_variant(part) rlike '^(OBJECT|ARRAY)<', false))
"""

_REASON = f"""
case when _fault is not null then _fault
     when _record.{_CORRUPT} is not null or case when {_SUSPECT} then ({_NESTED}) else false end then 'BAD_FIELD_TYPE'
     when coalesce(_record.type not in {SUBMISSION_TYPES}, true) then 'UNKNOWN_TYPE' end
"""


def decode_submissions(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the submission's fields and ``reason`` (null if valid) to each row of ``df``.

    ``value`` holds one JSON object per row. The reason is the first that applies of

    ==============  ===========================================================================
    MALFORMED       not a JSON object
    NOTEBOOK        has the key ``appId``: a request to launch a notebook, see `notebook_requests`
    UNKNOWN_FIELD   a key that submissions do not have
    BAD_FIELD_TYPE  a value of the wrong kind, such as text for ``arguments``, or a repeated key in a submission in
                    which a text begins with a bracket or brace, so that its kind cannot be told
    UNKNOWN_TYPE    ``type`` is absent or not one of the known names
    ==============  ===========================================================================
    """
    text = quoted(value)
    parts = ", ".join(f"try_variant_get(try_parse_json({text}), '$.{name}', 'variant')" for name in _TEXT_FIELDS)
    reason = _REASON.replace("{text}", parts).replace("{value}", text)
    options = f"map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '{_CORRUPT}')"
    record = f"from_json({text}, '{SUBMISSION_DDL}, {_CORRUPT} string', {options})"
    # As generated rows, so that a filter on the outcome is not pushed below the parsing and parses again. The record
    # is parsed only where the keys are in order: failing to parse takes far longer than parsing.
    staged = df.selectExpr("*", f"inline(array(struct(json_object_keys({text}) as _keys)))")
    staged = staged.selectExpr("*", f"inline(array(struct({_KEY_FAULT} as _fault)))")
    staged = staged.selectExpr("*", f"inline(array(struct(case when _fault is null then {record} end as _record)))")
    return staged.selectExpr(
        *[quoted(name) for name in df.columns],
        *[f"_record.{name} as {name}" for name in SUBMISSION_FIELDS],
        f"{reason} as reason",
    )


def valid_submissions(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull()).drop("reason")


def rejected_submissions(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNotNull()).drop(*SUBMISSION_FIELDS)


def notebook_requests(decoded: DataFrame, value: str = "value") -> DataFrame:
    """The notebook requests with their launch arguments; null when those are absent or not a list."""
    arguments = F.try_variant_get(F.try_parse_json(F.col(value)), "$.configOverrides.arguments", "array<string>")
    return (
        decoded.filter(F.col("reason") == "NOTEBOOK")
        .drop("reason", *SUBMISSION_FIELDS)
        .withColumn("launch_arguments", arguments)
    )


def base64_text(code: Column) -> Column:
    """Base64 to text; null if the input is not base64."""
    return F.try_to_binary(code, F.lit("base64")).cast("string")


def with_default(column: Column, default: str) -> Column:
    """``column``, or ``default`` where it is absent."""
    return F.coalesce(column, F.lit(default))


def route_submissions(valid: DataFrame) -> DataFrame:
    """Add what each submission asks for.

    ``route`` is ``sql``, ``job`` or ``unsupported``; ``program`` the plain text of ``code``, or of type JAVA the class that
    is named; ``inline`` is true when the result has no path of its own.
    """
    kind = F.col("type")
    named = (kind == "JAVA") & (with_default(F.col("className"), "") != "")
    return valid.select(
        "*",
        F.when(kind == "SQL", "sql").when(kind.isin(*_JOB_TYPES) | named, "job").otherwise("unsupported").alias("route"),
        F.when(kind == "PYTHON_BASE64", base64_text(F.col("code")))
        .when(named, F.col("className")).otherwise(F.col("code")).alias("program"),
        (with_default(F.col("resultsPath"), "") == "").alias("inline"),
    )


def key_value_map(text: Column) -> Column:
    """``k=v,k=v`` to a map: parts without ``=`` are skipped, the first ``=`` splits, the last of equal keys wins."""
    parts = F.filter(F.split(text, ",", -1), lambda part: F.instr(part, "=") > 0)

    def put(entries: Column, part: Column) -> Column:
        key = F.substring_index(part, "=", 1)
        value = F.substr(part, F.instr(part, "=") + 1)
        return F.map_concat(F.map_filter(entries, lambda k, _: k != key), F.create_map(key, value))

    return F.aggregate(parts, F.create_map().cast("map<string,string>"), put)
