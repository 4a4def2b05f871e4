"""Run submissions as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from slipway.operators.runner import Runner
from slipway.sources.submissions import read_submission_stream


def stream_submissions(
    spark: SparkSession,
    path: str,
    runner: Runner,
    checkpoint: str,
    available_now: bool = False,
    whole_files: bool = False,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Run what arrives in the folder ``path``, with ``runner``; outcomes are in its status table.

    A batch that is cut off is delivered again. Submissions with a recorded outcome are then skipped; one that was
    under way runs again, which is safe for a query whose result overwrites a path, but not for DDL or INSERT.
    """

    # A stream's own session runs without adaptive execution; submissions take the settings of ``spark``.
    def run_batch(batch: DataFrame, _batch_id: int) -> None:
        runner.run(batch, spark)

    writer = (
        read_submission_stream(spark, path, whole_files, max_files_per_trigger)
        .writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
