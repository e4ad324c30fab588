"""A time limit for the jobs of an epoch."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import SparkSession

#: Seconds between two rounds of cancelling, as a plan may start further jobs.
_AGAIN = 0.2


class Deadline:
    """Cancels the jobs that this thread, and threads that inherit from it, start inside the
    ``with`` block and that still run after ``seconds``."""

    def __init__(self, spark: SparkSession, seconds: float):
        self._context, self._seconds = spark.sparkContext, seconds
        self._tag = f"tidegate-{uuid.uuid4().hex}"
        self._done = threading.Event()
        self.passed = False

    def _watch(self) -> None:
        if self._done.wait(self._seconds):
            return
        self.passed = True
        while not self._done.wait(_AGAIN):
            self._context.cancelJobsWithTag(self._tag)

    def __enter__(self) -> Deadline:
        self._context.addJobTag(self._tag)
        threading.Thread(target=self._watch, daemon=True).start()
        return self

    def __exit__(self, *error) -> None:
        self._done.set()
        self._context.removeJobTag(self._tag)
