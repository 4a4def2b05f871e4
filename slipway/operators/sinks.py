"""Write results so that a failed run leaves the previous result in place, and read them back."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from slipway.session import file_path, file_system

MICROSECONDS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

PADDING = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Text formats lose data with their defaults: newlines, padding, empty text against null, and all below a millisecond.
# With these options a result reads back as it was.
_OPTIONS: dict[str | None, dict[str, str]] = {
    "csv": {
        "escape": '"',
        "lineSep": "\n",
        **PADDING,
        **MICROSECONDS,
    },
    "json": dict(MICROSECONDS),
    "xml": {"rowTag": "row", "ignoreSurroundingSpaces": "false", **MICROSECONDS},
}


# A row may span lines in these formats, so a task reads a file of them whole. Small files share a task.
WHOLE_FILE_FORMATS = ("csv", "xml")
ROWS_PER_FILE = 20_000


def write_options(result_format: str | None, columns: int) -> dict[str, str]:
    options = dict(_OPTIONS.get(result_format, {}))
    if result_format in WHOLE_FILE_FORMATS:
        options["maxRecordsPerFile"] = str(ROWS_PER_FILE)
    if result_format == "csv" and columns == 1:
        # A null is an empty field, and a line that is empty is skipped. So a lone column marks its nulls, and text
        # equal to the mark is the one thing that does not come back.
        options["nullValue"] = r"\N"
    return options


def read_options(result_format: str | None, columns: int) -> dict[str, str]:
    options = write_options(result_format, columns)
    if result_format == "csv":
        options["multiLine"] = "true"
        # Spark reads an empty field as this text and this text as null. No text in the data is equal to a new UUID.
        options.setdefault("nullValue", uuid.uuid4().hex)
    return options


_swap_locks: dict[str, threading.Lock] = {}


class _Folder:
    """A result folder and its hidden siblings."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        target = file_path(spark, path)
        self._path_class = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = file_system(spark, target)
        self._target = self._fs.makeQualified(target)
        self._old = self._sibling("_old")
        self._staging = self._sibling(f"_staging-{uuid.uuid4().hex}")
        # One for each target: a rename that copies, as on object stores, holds up no other result.
        self._lock = _swap_locks.setdefault(self._target.toString(), threading.Lock())

    def _sibling(self, suffix: str) -> Any:
        return self._path_class(self._target.getParent(), f".{self._target.getName()}.{suffix}")

    @property
    def staging(self) -> str:
        return self._staging.toString()

    def restore(self) -> None:
        """Undo a swap that stopped between its two renames."""
        with self._lock:
            if self._fs.exists(self._old) and not self._fs.exists(self._target):
                self._fs.rename(self._old, self._target)

    def discard_staging(self) -> None:
        self._fs.delete(self._staging, True)

    def swap(self) -> None:
        with self._lock:
            if self._fs.exists(self._target):
                self._fs.delete(self._old, True)
                self._rename(self._target, self._old)
            self._rename(self._staging, self._target)
            self._fs.delete(self._old, True)

    def _rename(self, source: Any, target: Any) -> None:
        if not self._fs.rename(source, target):
            raise OSError(f"could not rename {source.toString()} to {target.toString()}")


def write_result(
    df: DataFrame, path: str, result_format: str | None = None, options: Mapping[str, str] | None = None
) -> None:
    """Overwrite ``path`` with ``df`` in any format Spark can write; without a name, in the session's default format.

    The rows go to a new folder beside ``path`` first and take its place by rename once they are complete. So a run
    that fails leaves the old result untouched, and a query may overwrite a path it reads. Files of formats that are read
    file by file hold `ROWS_PER_FILE` rows at most, unless ``options`` say otherwise. On file systems whose
    rename is a copy, such as object stores, the swap takes time and is not atomic; a swap cut off half-way is undone
    by the next write or read.
    """
    folder = _Folder(df.sparkSession, path)
    folder.restore()
    writer = df.write
    if result_format:
        writer = writer.format(result_format)
    try:
        writer.options(**{**write_options(result_format, len(df.columns)), **(options or {})}).save(folder.staging)
        folder.swap()
    except Exception:
        folder.discard_staging()
        folder.restore()
        raise


def read_result(
    spark: SparkSession, path: str, result_format: str | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """Read what `write_result` wrote. Text formats need the ``schema`` the result had."""
    _Folder(spark, path).restore()
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.options(**read_options(result_format, len(fields or ())))
    if result_format:
        reader = reader.format(result_format)
    if fields is not None:
        reader = reader.schema(fields)
    return reader.load(path)


def resolve_path(spark: SparkSession, root: str, path: str) -> str:
    """``path`` below ``root``, taken relative to it if not absolute; raises `PermissionError` if it leads elsewhere.

    Names that begin with ``_`` or ``.`` are refused as well: Spark hides them from readers.
    """

    def qualified(p: Any) -> str:
        return file_system(spark, p).makeQualified(p).toString()

    base, target = file_path(spark, root), file_path(spark, path)
    top = qualified(base).rstrip("/")
    full = qualified(target if target.isAbsolute() else file_path(spark, f"{root.rstrip('/')}/{path}"))
    below = full[len(top) + 1 :].split("/") if full.startswith(top + "/") else []
    if not below or any(name.startswith(("_", ".")) for name in below):
        raise PermissionError(f"{path!r} is not a result path below {root!r}")
    return full


# The name and columns of the connection table.
CONNECTION_VIEW = "spark_connect_info"
CONNECTION_DDL = "type string, port int, secret string"


def literal_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], ddl: str) -> DataFrame:
    """A small table from rows at hand. A value that does not fit its declared type raises."""
    return spark.createDataFrame(rows, ddl)


def publish_global_view(df: DataFrame, name: str) -> None:
    """Make ``df`` readable as ``global_temp.<name>`` from every session of the context."""
    df.createOrReplaceGlobalTempView(name)


def publish_connections(
    spark: SparkSession, rows: Sequence[tuple[str, int, str]], path: str | None = None
) -> DataFrame:
    """Publish the connection table, and also write it to ``path`` in the default format if one is given."""
    table = literal_rows(spark, rows, CONNECTION_DDL)
    publish_global_view(table, CONNECTION_VIEW)
    if path:
        write_result(table, path)
    return table
