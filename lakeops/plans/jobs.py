"""Run one load for each of several tables."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark import SparkContext, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

STATUS_SCHEMA = "table_name string, succeeded boolean, seconds double, result string, error string"


class LoadError(Exception):
    """Some tables failed; the others are loaded. ``errors`` maps a table to its exception."""

    def __init__(self, errors: dict[str, Exception], status: DataFrame):
        super().__init__("; ".join(f"{name}: {error}" for name, error in errors.items()))
        self.errors = errors
        self.status = status


class _Limit:
    """Cancels the Spark jobs that its thread submits once a time has passed, until it is left."""

    EVERY = 0.2

    def __init__(self, context: SparkContext, tag: str, seconds: float):
        self.context, self.tag, self.seconds = context, tag, seconds
        self.passed = False
        self._left = threading.Event()

    def __enter__(self) -> None:
        self.context.addJobTag(self.tag)
        self._watcher = threading.Thread(target=self._watch, daemon=True)
        self._watcher.start()

    def _watch(self) -> None:
        if self._left.wait(self.seconds):
            return
        self.passed = True
        while not self._left.wait(self.EVERY):
            self.context.cancelJobsWithTag(self.tag)

    def __exit__(self, kind, *_) -> None:
        self._left.set()
        self._watcher.join()
        self.context.removeJobTag(self.tag)
        if self.passed and kind is None:
            # Too late is too late, whether or not a job was there to cancel.
            raise TimeoutError(f"took more than {self.seconds:g} seconds")


def run_tables(
    spark: SparkSession,
    names: Iterable[str],
    load: Callable[[str], object],
    workers: int = 4,
    seconds: float | None = None,
) -> DataFrame:
    """Submit the loads from a few threads; Spark runs their jobs side by side.

    Returns one status row per table. A failing table does not stop the others; once all are done
    the failures are raised together. With ``seconds`` a table that takes longer fails with a
    ``TimeoutError``: its jobs, known by a tag of their own, are cancelled, and so are those that it
    still submits. Each table has a scheduler pool of its name, so that with
    ``spark.scheduler.mode=FAIR`` a large table leaves the others their share of the cluster.
    """
    errors: dict[str, Exception] = {}
    context = spark.sparkContext

    def attempt(name: str) -> tuple:
        started = time.monotonic()
        context.setLocalProperty("spark.scheduler.pool", name)
        limit = None if seconds is None else _Limit(context, f"lakeops-{name}-{uuid.uuid4().hex}", seconds)
        try:
            with limit or nullcontext():
                result = load(name)
        except Exception as error:
            if limit is not None and limit.passed:
                error = TimeoutError(f"stopped after {seconds:g} seconds")
            errors[name] = error
            return name, False, time.monotonic() - started, None, str(error)
        text = None if result is None else str(result)
        return name, True, time.monotonic() - started, text, None

    with ThreadPoolExecutor(max_workers=workers) as pool:
        # Wrapped anew per table: each thread needs its own copy of the local properties.
        tasks = [pool.submit(inheritable_thread_target(spark)(attempt), name) for name in names]
        rows = [task.result() for task in tasks]
    status = spark.createDataFrame(rows, STATUS_SCHEMA)
    if errors:
        raise LoadError(errors, status)
    return status
