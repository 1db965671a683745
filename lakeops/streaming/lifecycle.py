"""Watch running streams, let them finish what has arrived, and stop them between batches."""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class Progress:
    """What is known of one stream: its batches with rows, the rows, and how it ended."""

    batches: int = 0
    rows: int = 0
    last_batch: int = -1
    idle: int = 0
    ended: bool = False
    error: str | None = None


class Watch(StreamingQueryListener):
    """Keeps the progress of each run; an event of a batch counts once, however often it is sent."""

    def __init__(self) -> None:
        self._changed = threading.Condition()
        self._runs: dict[str, Progress] = {}

    def progress(self, run: StreamingQuery) -> Progress:
        with self._changed:
            return self._runs.setdefault(str(run.runId), Progress())

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._runs.setdefault(str(event.runId), Progress())

    def onQueryProgress(self, event) -> None:
        batch = event.progress
        with self._changed:
            known = self._runs.setdefault(str(batch.runId), Progress())
            if batch.numInputRows and batch.batchId > known.last_batch:
                known.batches += 1
                known.rows += batch.numInputRows
                known.last_batch = batch.batchId
            known.idle = 0
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        with self._changed:
            self._runs.setdefault(str(event.runId), Progress()).idle += 1
            self._changed.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            known = self._runs.setdefault(str(event.runId), Progress())
            known.ended, known.error = True, event.exception
            self._changed.notify_all()

    def wait_ended(self, run: StreamingQuery, seconds: float) -> Progress:
        """The progress of a run once it is told to have ended; events follow their cause after a while."""
        until = time.monotonic() + seconds
        with self._changed:
            while not self._runs.setdefault(str(run.runId), Progress()).ended and time.monotonic() < until:
                self._changed.wait(until - time.monotonic())
            return self._runs[str(run.runId)]


class watching:
    """``with watching(spark) as watch:`` keeps the progress of the streams that run meanwhile."""

    def __init__(self, spark: SparkSession):
        self.spark, self.watch = spark, Watch()

    def __enter__(self) -> Watch:
        self.spark.streams.addListener(self.watch)
        return self.watch

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self.watch)


def drain(run: StreamingQuery) -> None:
    """Return when everything that had arrived before the call is processed."""
    run.processAllAvailable()


def stop(run: StreamingQuery, seconds: float = 60.0) -> None:
    """Stop a stream after what has arrived; raise if it failed, or is not over in time.

    A batch that a stop cuts off is run again by the next start from the same checkpoint, into the same
    place, so no row is lost or doubled.
    """
    if run.isActive:
        drain(run)
    run.stop()
    if not run.awaitTermination(seconds):
        raise TimeoutError(f"the stream {run.name or run.id} did not stop within {seconds} s")
