"""Run SQL text and named jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, Sequence[str], Mapping[str, str]], DataFrame]


def run_sql(session: SparkSession, code: str, args: Sequence[Any] | Mapping[str, Any] | None = None) -> DataFrame:
    """One SQL statement. ``args`` are bound as values: a sequence to ``?``, a mapping to ``:name``."""
    return session.sql(code, args=args) if args else session.sql(code)


class JobRegistry:
    """Programs that submissions may name. A submission's text is looked up here and never executed."""

    def __init__(self) -> None:
        self._jobs: dict[str, Job] = {}

    def register(self, name: str) -> Callable[[Job], Job]:
        def add(job: Job) -> Job:
            if name in self._jobs:
                raise ValueError(f"job {name!r} is already registered")
            self._jobs[name] = job
            return job

        return add

    def run(
        self,
        session: SparkSession,
        name: str,
        arguments: Sequence[str] | None = None,
        environment: Mapping[str, str] | None = None,
    ) -> DataFrame:
        job = self._jobs.get((name or "").strip())
        if job is None:
            raise LookupError(f"no job is registered as {name!r}")
        return job(session, list(arguments or ()), dict(environment or {}))
