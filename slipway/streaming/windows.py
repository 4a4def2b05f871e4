"""Event-time windows over a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slipway.operators.sinks import write_result


def tumbling_counts(
    events: DataFrame, time: str, keys: list[str | Column], width: str, lateness: str | None = None
) -> DataFrame:
    """Rows per window and key. ``time`` must be a ``timestamp``; with ``lateness`` a watermark closes old windows."""
    if lateness is not None:
        events = events.withWatermark(time, lateness)
    return events.groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))


def distinct_events(events: DataFrame, time: str, keys: list[str], lateness: str) -> DataFrame:
    """Each event once, if its copies arrive within ``lateness`` of it; what is kept of an event goes after that."""
    return events.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def write_latest(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep ``path`` at the complete result of a streaming aggregation, until the input that is there is used up."""
    return (
        result.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _batch_id: write_result(batch, path, "parquet"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_closed(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each window to ``path`` once the watermark has closed it."""
    return (
        result.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
