import json

import pytest
from pyspark.sql import functions as F

from slipway.operators.runner import Runner
from slipway.operators.sinks import read_result
from slipway.streaming.submissions import stream_submissions
from slipway.streaming.windows import append_closed, tumbling_counts, write_latest


@pytest.fixture
def inbox(tmp_path):
    path = tmp_path / "inbox"
    path.mkdir()
    return path


def test_stream_goes_on_past_bad_submissions(spark, tmp_path, inbox):
    runner = Runner(str(tmp_path / "results"))

    def drain():
        stream_submissions(
            spark, str(inbox), runner, str(tmp_path / "checkpoint"), available_now=True, max_files_per_trigger=1
        ).awaitTermination()
        return sorted((r.source_file.rsplit("/", 1)[1], r.state) for r in runner.status(spark).collect())

    def deliver(name, **fields):
        (inbox / name).write_text(json.dumps(fields))

    (inbox / "a.json").write_text("{bad")
    deliver("b.json", type="SQL", code="select raise_error('x') as a", resultsPath="b")
    deliver("c.json", type="SQL", code="select 7 as a", resultsPath="c")
    first = [("a.json", "REJECTED"), ("b.json", "FAILED"), ("c.json", "OK")]
    assert drain() == first
    assert read_result(spark, f"{runner.results_root}/c").first().a == 7
    assert drain() == first
    deliver("d.json", type="SQL", code="select 8 as a", resultsPath="d")
    assert drain() == [*first, ("d.json", "OK")]


def test_a_batch_delivered_again_is_not_run_again(spark, tmp_path, inbox):
    runner = Runner(str(tmp_path / "results"))
    (inbox / "a.json").write_text(json.dumps({"type": "SQL", "code": "select rand() as r", "resultsPath": "a"}))
    for checkpoint in ("one", "two"):
        stream_submissions(spark, str(inbox), runner, str(tmp_path / checkpoint), available_now=True).awaitTermination()
        result = read_result(spark, f"{runner.results_root}/a").collect()
        if checkpoint == "one":
            first = result
    assert result == first
    assert runner.status(spark).count() == 1


def test_views_made_after_the_start_are_seen(spark, tmp_path, inbox):
    runner = Runner(str(tmp_path / "results"), setup=lambda s: s.range(3).createOrReplaceTempView("late"))
    query = stream_submissions(spark, str(inbox), runner, str(tmp_path / "checkpoint"))
    try:
        (inbox / "a.json").write_text(json.dumps({"type": "SQL", "code": "select * from late", "resultsPath": "a"}))
        query.processAllAvailable()
    finally:
        query.stop()
    assert read_result(spark, f"{runner.results_root}/a").count() == 3


@pytest.fixture
def clicks(spark, tmp_path):
    path = str(tmp_path / "clicks")
    minutes = [0, 10, 59, 60, 61, 150, 400]
    rows = spark.createDataFrame([(m * 60, "a" if m < 100 else "b") for m in minutes], "s long, k string")
    rows.select(F.timestamp_seconds("s").alias("ts"), "k").write.parquet(path)
    return spark.readStream.schema("ts timestamp, k string").parquet(path)


def windows(df):
    return sorted((r.w, r.k, r.n) for r in df.collect())


def test_complete_windows(spark, tmp_path, clicks):
    counts = tumbling_counts(clicks, "ts", ["k"], "1 hour")
    flat = counts.select((F.unix_timestamp("window.start") / 3600).cast("int").alias("w"), "k", "n")
    write_latest(flat, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert windows(read_result(spark, str(tmp_path / "out"))) == [(0, "a", 3), (1, "a", 2), (2, "b", 1), (6, "b", 1)]


def test_windows_closed_by_the_watermark(spark, tmp_path, clicks):
    counts = tumbling_counts(clicks, "ts", ["k"], "1 hour", lateness="3 hours")
    flat = counts.select((F.unix_timestamp("window.start") / 3600).cast("int").alias("w"), "k", "n")
    append_closed(flat, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    # The watermark stands at 400 - 180 = 220 minutes: the window of minute 400 is still open.
    assert windows(spark.read.parquet(str(tmp_path / "out"))) == [(0, "a", 3), (1, "a", 2), (2, "b", 1)]
