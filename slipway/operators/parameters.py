"""Typed arguments of submitted SQL, by place or by name."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARAMETERS = "parameters"


def bindings(session: SparkSession, config: str | None, arguments: Sequence[str] | None) -> list[Any] | dict[str, Any] | None:
    """What a submission binds: the ``parameters`` of its ``config``, or else its ``arguments``, as texts.

    ``config`` may be a JSON object. Its ``parameters`` are a list, for ``?``, or an object, for ``:name``. A value has the
    type that it shows: a whole number, a decimal (all digits of a number with a point, no rounding), true or false, text,
    null, a list or an object of these (array, struct). ``{"type": t, "value": v}`` has the type ``t``, any of Spark's that JSON
    can hold, such as ``date``, ``timestamp``, ``decimal(20, 4)``, ``array<date>`` or ``map<string, int>``; a value that does
    not fit it raises `ValueError`. A ``config`` that is no JSON object, or has no ``parameters``, binds nothing.
    """
    given = _parameters(config)
    if given is None:
        return list(arguments) if arguments else None
    if isinstance(given, list):
        return [_bound(session, value) for value in given]
    if isinstance(given, dict):
        return {name: _bound(session, value) for name, value in given.items()}
    raise ValueError(f"{PARAMETERS} are a list or an object, not {json.dumps(given)}")


def _parameters(config: str | None) -> Any:
    try:
        whole = json.loads(config or "", parse_float=Decimal)
    except ValueError:
        return None
    return whole.get(PARAMETERS) if isinstance(whole, dict) else None


def _bound(session: SparkSession, value: Any) -> Any:
    if isinstance(value, Mapping) and value.keys() == {"type", "value"}:
        value = _typed(session, value["type"], value["value"])
    return _literal(value) if isinstance(value, (list, tuple, Mapping)) else value


def _typed(session: SparkSession, kind: str, value: Any) -> Any:
    """``value`` as Spark reads it from JSON as ``kind``."""
    if value is None:
        return None
    schema = StructType.fromDDL(f"v {kind}")
    if len(schema) != 1:
        raise ValueError(f"{kind} is not one type")
    text = json.dumps({"v": value}, default=str)
    row = session.range(1).select(F.from_json(F.lit(text), schema, {"mode": "PERMISSIVE"}).v.alias("v")).first()
    if row.v is None:
        raise ValueError(f"{json.dumps(value, default=str)} is no {kind}")
    return row.v


def _literal(value: Any) -> Column:
    """Lists, maps and rows as the constructors that SQL takes for arguments."""
    if isinstance(value, tuple) and hasattr(value, "asDict"):
        value = value.asDict()
        return F.named_struct(*[part for name, own in value.items() for part in (F.lit(name), _literal(own))])
    if isinstance(value, Mapping):
        if not value:
            return F.create_map()
        return F.named_struct(*[part for name, own in value.items() for part in (F.lit(name), _literal(own))])
    if isinstance(value, (list, tuple)):
        return F.array(*[_literal(part) for part in value])
    return F.lit(value)
