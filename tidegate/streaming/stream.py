"""Streaming inserts: every micro-batch is one epoch.

A micro-batch is flushed completely before its offsets are committed, so no partial
batch is carried over, and one that runs again replaces what it wrote before.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import replace

from pyspark.sql import DataFrame

from .. import storage
from ..errors import OptionError
from ..operators.sink import (Epoch, InsertPlan, InsertResult, dry_run, insert_epoch,
                             plan_insert)
from ..options import InsertOptions
from ..sources.tables import TableStore

# The triggers a streaming insert accepts.
TRIGGERS = ("availableNow", "processingTime")


def query_writer(query_id: str) -> str:
    """The writer of a stream: its id lives in the checkpoint, so a restart keeps it and a
    checkpoint that is made anew, be it at the same path, has another."""
    return f"stream-{query_id}"


def checkpoint_writer(spark, checkpoint: str) -> str:
    """The writer of the stream that a checkpoint belongs to."""
    path = f"{checkpoint.rstrip('/')}/metadata"
    if not storage.exists(spark, path):
        return writer_of(checkpoint)
    return query_writer(json.loads(spark.read.text(path).first()[0])["id"])


def writer_of(checkpoint: str) -> str:
    """The writer for a checkpoint path, where no query is known."""
    return "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def trigger_arguments(trigger) -> dict:
    if trigger is None:
        return {}
    if trigger == "availableNow":
        return {"availableNow": True}
    if isinstance(trigger, str):
        return {"processingTime": trigger}
    if isinstance(trigger, dict) and len(trigger) == 1 and next(iter(trigger)) in TRIGGERS:
        return dict(trigger)
    raise OptionError(f"trigger must be one of {', '.join(TRIGGERS)}, not {trigger!r}")


class EpochWriter:
    """Writes the micro-batches of one stream; call it from ``foreachBatch``.

    ``store``: where to write, in place of the target that the options name.
    """

    def __init__(self, df: DataFrame, options: InsertOptions, store: TableStore | None = None):
        spark = df.sparkSession
        if not (options.writer or options.checkpoint):
            raise OptionError("a streaming insert needs a checkpoint location")
        self.writer = options.writer or writer_of(options.checkpoint)
        self.store = store or TableStore(spark, table=options.table, database=options.database,
                                         path=options.path)
        self._named = bool(options.writer)
        self.plan = replace(plan_insert(df, options, self.store), streaming=True)
        # Verdict and rows must come from one evaluation unless the caller knows better.
        self.evaluate_once = True if options.evaluate_once is None else options.evaluate_once
        self._scratch = storage.scratch_path(spark, self.writer)

    def __call__(self, batch: DataFrame, epoch: int) -> Epoch:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query and not self._named:
            self.writer = query_writer(query)
        scratch = f"{self._scratch}-{epoch}"
        try:
            return insert_epoch(batch, self.plan, self.store, self.writer, epoch,
                                self.evaluate_once, scratch)
        finally:
            storage.remove(batch.sparkSession, scratch)

    def result(self, query=None) -> InsertResult:
        if query is not None and not self._named:
            self.writer = query_writer(query.id)
        return InsertResult(self.plan, self.store, self.writer, None, query=query)


def insert_stream(df: DataFrame, options: InsertOptions):
    trigger = trigger_arguments(options.trigger)
    if not options.checkpoint:
        raise OptionError("a streaming insert needs a checkpoint location")
    if options.track_batches:
        raise OptionError("track_batches is for batch inserts; epochs of a stream are transient")
    if options.epoch is not None:
        raise OptionError("a stream numbers its epochs itself")
    if options.dry_run:
        return _dry_stream(df, options, trigger)
    writer = EpochWriter(df, options)

    def write(batch: DataFrame, epoch: int) -> None:
        writer(batch, epoch)

    query = (df.writeStream.foreachBatch(write)
             .option("checkpointLocation", options.checkpoint).trigger(**trigger).start())
    return writer.result(query)


class DryStreamResult:
    """A stream whose rows are converted and not written."""

    def __init__(self):
        self.query = None
        self._converted = 0

    def count(self, batch: DataFrame, plan: InsertPlan) -> None:
        self._converted += dry_run(batch, plan).metrics["rows_converted"]

    @property
    def metrics(self) -> dict:
        return {"rows_converted": self._converted, "rows_written": 0}

    def await_termination(self, timeout: float | None = None):
        return self.query.awaitTermination(timeout)


def _dry_stream(df: DataFrame, options: InsertOptions, trigger: dict) -> DryStreamResult:
    plan = plan_insert(df, options, None)
    done = DryStreamResult()
    done.query = (df.writeStream.foreachBatch(lambda batch, _: done.count(batch, plan))
                  .option("checkpointLocation", options.checkpoint).trigger(**trigger).start())
    return done
