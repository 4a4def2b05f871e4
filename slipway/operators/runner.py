"""Run a table of submissions, each in a session of its own, and record every outcome."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from slipway.operators.decode import decode_submissions, route_submissions, submission_id
from slipway.operators.execute import JobRegistry, run_sql
from slipway.operators.parameters import bindings
from slipway.operators.render import body_of, render
from slipway.operators.sinks import resolve_path, write_result
from slipway.operators.status import (
    ACCEPTED_SUFFIX, COMPACT_AFTER, PARSE_FAILURE, SUBMIT_FAILURE, StatusStore, accepted, append_status_if_any, append_status_rows, status_table,
)
from slipway.operators.versions import read_version, write_version
from slipway.session import Setup, open_session, remove, settings_of, size_shuffles, work_path


# Lines per file of an inline answer: what a page of an answer reads is some of these files, whole.
ANSWER_BLOCK = 100_000
# Stored bytes per partition of the staged submissions: what the driver holds of them at a time.
_STAGED_BYTES = 16 << 20


def _describe(error: Exception) -> tuple[str, str]:
    """The error condition, or the exception's name where it has none, and the message."""
    if isinstance(error, PySparkException):
        return error.getCondition() or type(error).__name__, str(error)
    if isinstance(error, Py4JJavaError):
        cause = error.java_exception
        has_condition = is_instance_of(SparkContext._gateway, cause, "org.apache.spark.SparkThrowable")
        return (cause.getCondition() if has_condition else cause.getClass().getSimpleName()), cause.getMessage()
    return type(error).__name__, str(error)


# Names, in an error or one of its causes, of what may be over by the next attempt.
_PASSING = ("ExecutorLostFailure", "FetchFailed", "java.net.", "NoRouteToHost", "SocketTimeout", "ConnectException")


def is_transient(error: Exception) -> bool:
    """Whether another attempt may do better: lost executors and connections, not faults of the query."""
    if isinstance(error, (ConnectionError, TimeoutError)):
        return True
    return isinstance(error, (Py4JJavaError, PySparkException)) and any(name in str(error) for name in _PASSING)


# Files carry the number of their partition, then that of their block; by name alone, 1000 would come before 999.
_IN_ORDER = ("_part", "_piece", "_block", "_line")


def _answer_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``value`` of each line below ``paths``, and where it stands: ``_file``, ``_part``, ``_piece``, ``_block``, ``_line``."""
    name = F.col("_metadata.file_name")
    return spark.read.option("lineSep", "\n").text([*paths]).select(
        "value", name.alias("_file"),
        F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long").alias("_part"),
        F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("long").alias("_piece"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"),
    )


def _answer_index(spark: SparkSession, path: str) -> DataFrame:
    """``_file``, its number of ``lines``, and where it ``begins`` in the answer: kept below ``path``, made if it is not there.

    Two readers may both make it, each as a version of its own with the same rows. The sum over files in their order is
    one task's, a row for each ``ANSWER_BLOCK`` lines.
    """
    place = f"{path}/_index"
    try:
        return read_version(spark, place)
    except LookupError:
        counts = _answer_lines(spark, path).groupBy("_file", "_part", "_piece").agg(F.count("*").alias("lines"))
        sums = counts.selectExpr("_file", "lines", "sum(lines) over (order by _part, _piece, _file) - lines as begins")
        write_version(sums, place, "parquet")
        return read_version(spark, place)


class _Watch:
    """Stops the Spark jobs of one submission when asked to, or at its time limit, until the submission ends."""

    def __init__(self, context: SparkContext, tag: str, limit: float | None) -> None:
        self.reason: str | None = None
        self._context, self._tag, self._limit = context, tag, limit
        self._asked, self._ended = threading.Event(), threading.Event()
        self._thread = threading.Thread(target=self._watch, daemon=True)

    def _watch(self) -> None:
        asked = self._asked.wait(self._limit)
        if not self._ended.is_set():
            self.reason = "CANCELLED" if asked else "TIME_LIMIT"
            self._asked.set()
        # A query may be between two jobs, so asking once is not enough.
        while not self._ended.is_set():
            self._context.cancelJobsWithTag(self._tag)
            self._ended.wait(0.2)

    def __enter__(self) -> _Watch:
        self._context.addJobTag(self._tag)
        self._thread.start()
        return self

    def __exit__(self, *_: object) -> None:
        self._ended.set()
        self._asked.set()
        self._thread.join()
        self._context.removeJobTag(self._tag)

    def ask(self) -> None:
        self._asked.set()

    def pause(self, seconds: float) -> None:
        self._asked.wait(seconds)


@dataclass
class Runner:
    """Where submissions run and where their results go.

    ``setup`` gives each session its views and functions. ``jobs`` are the programs that may be named.
    ``session_conf`` is set in each session, for example ``{"spark.sql.ansi.enabled": "false"}``. At most
    ``max_parallel`` submissions run at a time, in the fair-scheduler pool ``pool`` if one is given. If ``versioned``,
    results with a path are put by version (``write_version``), to be read by ``read_version``.

    A submission that takes longer than ``time_limit`` seconds, or that ``cancel`` names, is stopped and recorded as
    ``CANCELLED``, for the reason ``TIME_LIMIT`` or ``CANCELLED``; a result that was there stays. One that fails by what
    ``transient`` calls passing is tried up to ``attempts`` times, with pauses that begin at ``pause`` seconds and double.
    If ``pool_by`` names an entry of a submission's ``environment``, its value is the submission's pool.
    """

    results_root: str
    setup: Setup | None = None
    jobs: JobRegistry = field(default_factory=JobRegistry)
    session_conf: Mapping[str, str] = field(default_factory=dict)
    max_parallel: int = 8
    pool: str | None = None
    status_batch: int = 200
    versioned: bool = False
    time_limit: float | None = None
    attempts: int = 1
    pause: float = 0.5
    transient: Callable[[Exception], bool] = is_transient
    pool_by: str | None = None
    _watches: dict[str, _Watch] = field(default_factory=dict, init=False, repr=False)
    _unwanted: set[str] = field(default_factory=set, init=False, repr=False)

    def cancel(self, submission: str) -> None:
        """Stop a submission that this runner runs, or will run; nothing happens to one that has ended."""
        self._unwanted.add(submission)
        if watch := self._watches.get(submission):
            watch.ask()

    @property
    def status_path(self) -> str:
        return f"{self.results_root}/_status"

    def inline_path(self, submission: str) -> str:
        """Where the rendered text of a result without a path of its own is kept."""
        return f"{self.results_root}/_inline/{submission}"

    def status(self, spark: SparkSession) -> DataFrame:
        return status_table(spark, self.status_path)

    def answer_rows(self, spark: SparkSession, submission: str) -> DataFrame:
        """The rendered rows, ``value``, of a result without a path, in the result's own order.

        Files are numbered in the order of the result's partitions and blocks, and lines stand in theirs.
        """
        return _answer_lines(spark, self.inline_path(submission)).orderBy(*_IN_ORDER).select("value")

    def answer_page(self, spark: SparkSession, submission: str, first: int, count: int) -> DataFrame:
        """``position`` (from 0) and ``value`` of the rows ``first`` to ``first + count - 1`` of `answer_rows`.

        Only the files that hold them are read; they have ``ANSWER_BLOCK`` lines at most. The lines of each file are
        counted when the first page is asked for, and kept beside them. Rows beyond the last are left out.
        """
        if first < 0 or count < 0:
            raise ValueError("a page begins at 0 or later and has no fewer than 0 rows")
        path = self.inline_path(submission)
        index = _answer_index(spark, path)
        ends = F.col("begins") + F.col("lines")
        wanted = index.where((F.col("begins") < first + count) & (ends > first)).collect() if count else []
        if not wanted:
            return spark.createDataFrame([], "position long, value string")
        begins = spark.createDataFrame([(row["_file"], row["begins"]) for row in wanted], "_file string, begins long")
        lines = _answer_lines(spark, *(f"{path}/{row['_file']}" for row in wanted)).join(F.broadcast(begins), "_file")
        # A window holds one file's lines.
        place = F.expr("row_number() over (partition by _file order by _block, _line)")
        paged = lines.select((F.col("begins") + place - 1).alias("position"), "value")
        return paged.where(F.col("position").between(first, first + count - 1)).orderBy("position")

    def answer(self, spark: SparkSession, submission: str) -> Iterator[str]:
        """The body of the answer to a submission whose result has no path, in pieces; `LookupError` if there is none."""
        known = self.status(spark).where((F.col("submission_id") == submission) & (F.col("state") == "OK"))
        row = known.select("results_path", "result_format").first()
        if row is None or row.results_path != self.inline_path(submission):
            raise LookupError(f"no inline result of submission {submission!r}")
        rows = self.answer_rows(spark, submission).toLocalIterator()
        return body_of((row.value for row in rows), row.result_format)

    def run(self, submissions: DataFrame, parent: SparkSession | None = None) -> DataFrame:
        """Run the rows of ``submissions`` (``value``, and ``source_file`` if known) and return the status table.

        A submission already in the status table is not run again, so delivery may repeat. Equal texts from one file
        are one submission, and ``deliveries`` counts them. Checking, routing and recording of what cannot run are
        Spark jobs over all rows. Only what can run comes to the driver, where queries have to be started: one
        partition at a time, with ``max_parallel`` submissions under way, so their number is not limited by memory.
        Their sessions take their settings from ``parent``, by default the session of ``submissions``.
        """
        spark = parent or submissions.sparkSession
        settings = {**settings_of(spark), **self.session_conf}
        staged = self._stage(submissions)
        reader = open_session(spark, {"spark.sql.files.maxPartitionBytes": str(_STAGED_BYTES)})
        try:
            self._run_staged(spark, reader.read.parquet(staged), settings)
        finally:
            remove(spark, staged)
        return self.status(spark)

    def _run_staged(self, spark: SparkSession, decoded: DataFrame, settings: Mapping[str, str]) -> None:
        # First the few that are delivered again, so that the status table is read but not shuffled.
        store = StatusStore(spark, self.status_path)
        if store.segments or store.tail:
            known = store.known(decoded.select("submission_id")).select("submission_id")
            decoded = decoded.join(known, "submission_id", "left_anti")
        routed = route_submissions(decoded)

        is_rejected = F.col("reason").isNotNull()
        not_run = routed.filter(is_rejected | (F.col("route") == "unsupported"))
        outcomes = not_run.select(
            "submission_id", "source_file", "deliveries",
            F.when(~is_rejected, F.col("type")).alias("type"),
            F.when(is_rejected, "REJECTED").otherwise("UNSUPPORTED").alias("state"),
            F.col("reason").alias("error_condition"),
            F.when(is_rejected, PARSE_FAILURE).otherwise(accepted(F.col("type"))).alias("response"),
        )
        with ThreadPoolExecutor(1) as recorder:
            recorded = recorder.submit(append_status_if_any, outcomes, self.status_path)
            self._run_all(spark, routed.filter(~is_rejected & (F.col("route") != "unsupported")), settings)
            recorded.result()
        if len(store.tail) >= COMPACT_AFTER:
            store.compact()

    def _stage(self, submissions: DataFrame) -> str:
        """Write the distinct submissions, decoded, to the work folder: later steps read them more than once."""
        source = F.col("source_file") if "source_file" in submissions.columns else F.lit(None).cast("string")
        unique = (
            submissions.select(F.col("value"), source.alias("source_file"))
            .groupBy("value", "source_file")
            .agg(F.count("*").alias("deliveries"))
            .withColumn("submission_id", submission_id(F.col("value"), F.col("source_file")))
        )
        path = work_path(submissions.sparkSession, "submissions")
        decode_submissions(unique).write.option("parquet.block.size", _STAGED_BYTES).parquet(path)
        return path

    def _run_all(self, spark: SparkSession, runnable: DataFrame, settings: Mapping[str, str]) -> None:
        outcomes: list[tuple] = []
        under_way: set[Future] = set()

        def settle(limit: int) -> None:
            nonlocal under_way
            while len(under_way) > limit:
                finished, under_way = wait(under_way, return_when=FIRST_COMPLETED)
                outcomes.extend(future.result() for future in finished)
                if len(outcomes) >= self.status_batch:
                    append_status_rows(spark, outcomes, self.status_path)
                    outcomes.clear()

        with ThreadPoolExecutor(self.max_parallel) as pool:
            for submission in self._rows(runnable):
                settle(self.max_parallel - 1)
                under_way.add(pool.submit(self._run_one, spark, settings, submission))
            settle(0)
        append_status_rows(spark, outcomes, self.status_path)

    def _rows(self, runnable: DataFrame) -> Iterator[Row]:
        return runnable.select(
            "submission_id", "source_file", "deliveries", "type", "route", "program", "arguments", "environment",
            "config", "resultFormat", "resultsPath", "inline",
        ).toLocalIterator()

    def _run_one(self, spark: SparkSession, settings: Mapping[str, str], submission: Row) -> tuple:
        started = datetime.now(timezone.utc)
        pool = (submission.environment or {}).get(self.pool_by, self.pool) if self.pool_by else self.pool
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        spark.sparkContext.setJobDescription(f"submission {submission.submission_id}")
        state, condition, message, path = "OK", None, None, None
        response = submission.type + ACCEPTED_SUFFIX
        with _Watch(spark.sparkContext, f"submission-{submission.submission_id}", self.time_limit) as watch:
            self._watches[submission.submission_id] = watch
            if submission.submission_id in self._unwanted:
                watch.ask()
            for attempt in range(1, self.attempts + 1):
                try:
                    path = self._execute(spark, settings, submission)
                    message = f"after {attempt} attempts" if attempt > 1 else None
                    break
                except Exception as error:
                    if watch.reason is None and attempt < self.attempts and self.transient(error):
                        watch.pause(self.pause * 2 ** (attempt - 1))
                        if watch.reason is None:
                            continue
                    state, response = "FAILED", SUBMIT_FAILURE
                    condition, message = _describe(error)
                    if watch.reason is not None:
                        state, condition = "CANCELLED", watch.reason
                    break
            del self._watches[submission.submission_id]
        return (
            submission.submission_id, submission.source_file, submission.type, state, condition, message, response,
            path, submission.resultFormat, submission.deliveries, started, datetime.now(timezone.utc),
        )

    def _execute(self, spark: SparkSession, settings: Mapping[str, str], submission: Row) -> str | None:
        if submission.inline:
            path = self.inline_path(submission.submission_id)
        else:
            path = resolve_path(spark, self.results_root, submission.resultsPath)
        session = open_session(spark, setup=self.setup, inherited=settings)
        if submission.route == "sql":
            result = run_sql(session, submission.program, bindings(session, submission.config, submission.arguments))
        else:
            result = self.jobs.run(session, submission.program, submission.arguments, submission.environment)
        if not result.columns and not submission.inline:
            return None  # the work is done, as that of an insert, and there is nothing to store
        size_shuffles(result)
        if submission.inline:
            write_result(render(result, submission.resultFormat), path, "text", {"maxRecordsPerFile": str(ANSWER_BLOCK)})
        elif self.versioned:
            write_version(result, path, submission.resultFormat)
        else:
            write_result(result, path, submission.resultFormat)
        return path
