"""Columns by their exact name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as SQL text that means the column of that name, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))
