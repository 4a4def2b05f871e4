"""Read submissions as rows of text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_submissions(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Submissions as ``value`` and ``source_file``: one JSON object per line, or per file with ``whole_files``."""
    return spark.read.text(path, wholetext=whole_files).select("value", _source_file())


def read_submission_stream(
    spark: SparkSession, path: str, whole_files: bool = False, max_files_per_trigger: int = 1000
) -> DataFrame:
    """The same as a stream over the files that arrive in the folder ``path``."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
        .text(path, wholetext=whole_files)
        .select("value", _source_file())
    )


def _source_file():
    return F.col("_metadata.file_path").alias("source_file")
