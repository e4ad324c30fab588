"""One epoch of a typed, batched, all-or-nothing-per-batch insert.

The payload is moved as little as the semantics allow:

* nothing can be rejected: the rows are converted and written in one map-only pass;
  batches follow from counts, or from a narrow pass over the stored order columns;
* rows can be rejected and have an order: only (channel, order columns, verdict) is
  shuffled to find the failed batches; the payload is then filtered by an anti-join
  against the keys of those batches;
* rows can be rejected and have no order: the rows are written to scratch space as
  they arrive, which pins their batches, and filtered from there.

An input that may differ when read again is first written to scratch space as it is.
"""

from __future__ import annotations

import logging
import time
import uuid
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..errors import DrainLimitExceeded, IngestError, InsertFailed, OptionError, SchemaMismatch
from ..functions.conform import ColumnPlan, conform, plan_columns, quoted
from ..functions.types import default_batch_size, split_keys, stream_columns, table_schema
from ..options import InsertOptions
from ..sources.tables import (CHANNEL_MARK, EPOCH, INSERTED, KINDS, SHARD, TRIAL_MARK, WRITER, TableSpec,
                              TableStore, check_schema, new_spec)
from .batching import (BAD, BATCH, CHANNEL, LOG_SCHEMA, arrival_offsets, batches_from_counts, channel_column,
                       log_from_batches, order_names, summarise_batches, with_batch_numbers)
from .deadline import Deadline
from .key_index import anti_join, index_epoch, key_names, without_stored_keys
from .keys import first_per_key, lay_out
from .numbering import PART, SEQ, number_rows, number_staged, stage

log = logging.getLogger(__name__)

BATCH_WRITER = "batch"
BROADCAST_ROWS = 2_000_000
# Channels that may commit apart, and how many of them are written at a time.
MOST_CHANNELS, CHANNELS_AT_A_TIME = 1000, 8
# Groups into which batches that could not be stored together are split, and failures in a row
# after which the store counts as down.
SPLIT, DOWN_AFTER = 8, 64
# Groups of batches that are tried at a time, and folders by place that their rows are read from.
TRIES_AT_A_TIME, SLICES = 8, 64
# Plan nodes that yield the same rows whenever they are read.
REPEATING_NODES = {
    "DataSourceV2Relation", "Filter", "Generate", "LocalRelation", "LogicalRelation", "Project",
    "Range", "SubqueryAlias", "Union", "View",
}


@dataclass(frozen=True)
class InsertPlan:
    """Everything decided on the driver before any data is read."""

    options: InsertOptions
    input_schema: T.StructType
    columns: list[ColumnPlan]
    schema: T.StructType
    spec: TableSpec
    batch_size: int
    channel: Column
    bad: Column | None
    streaming: bool = False

    @property
    def lossless(self) -> bool:
        return all(c.lossless for c in self.columns)

    @property
    def stores_all_results(self) -> bool:
        """Whether accepted rows cannot be shown again from the table alone."""
        return not self.lossless or self.options.dedupe_on_key


def plan_insert(df: DataFrame, options: InsertOptions, store: TableStore | None) -> InsertPlan:
    """Options, schemas and keys; creates the table when it is missing."""
    names = df.columns
    if len(set(names)) != len(names):
        raise SchemaMismatch(f"attribute names repeat: {names}")
    if not names:
        raise OptionError("the stream has no attributes")
    reserved = [n for n in names if n == INSERTED or n.startswith("_o") and n[2:].isdigit()
                or n.startswith("_key") and n[4:].isdigit()
                or n in (CHANNEL, BATCH, BAD, PART, SHARD, WRITER, EPOCH, "_pos", "_seq",
                         "_group_rows", "_salt", "_place", "_lost")]
    if reserved:
        raise OptionError(f"reserved attribute names: {', '.join(reserved)}")

    declared = stream_columns(options.schema, df.schema)
    by_name = {"match": options.match, "optional_mode": options.optional_mode,
               "timestamp_precision": options.timestamp_precision}
    columns = plan_columns(df.schema, declared, **by_name)
    schema = table_schema(declared)

    existing = store is not None and store.exists()
    if existing:
        spec = store.spec()
        check_schema(schema, spec.schema, options.match)
        columns = _in_table_order(columns, spec.schema, options.match)
    else:
        spec = new_spec(schema, split_keys(options.partitioning_key),
                        split_keys(options.primary_key), options.shards)
    if options.dedupe_on_key and not spec.primary_key:
        raise OptionError("dedupe_on_key needs a primary key")

    by_target = {c.target: c.expr for c in columns}
    plan = InsertPlan(
        options=options,
        input_schema=df.schema,
        columns=columns,
        schema=schema,
        spec=spec,
        batch_size=options.batch_size or default_batch_size(declared),
        channel=channel_column(options.channels, [by_target[k] for k in spec.partitioning_key]),
        bad=_bad_row(columns, spec, options.reject_when),
    )
    with_helpers(df, plan)          # unknown columns are refused before the table exists
    if store is not None and not existing:
        store.create(spec)
    return plan


def _in_table_order(columns: list[ColumnPlan], table: T.StructType, match: str) -> list[ColumnPlan]:
    if match == "name":
        planned = {c.target: c for c in columns}
        return [planned[f.name] for f in table.fields]
    return [replace(c, target=f.name) for c, f in zip(columns, table.fields)]


def _bad_row(columns: list[ColumnPlan], spec: TableSpec, reject_when) -> Column | None:
    """True for a row the table cannot take; None when no row can be like that.

    Parquet does not keep NOT NULL, so required columns are checked here.
    """
    reasons = [c.fails for c in columns if c.fails is not None]
    reasons += [quoted(c.source).isNull() for c, f in zip(columns, spec.schema.fields)
                if not f.nullable and c.may_be_null]
    if reject_when is not None:
        given = F.expr(reject_when) if isinstance(reject_when, str) else reject_when
        reasons.append(F.coalesce(given, F.lit(False)))
    return reduce(Column.__or__, reasons) if reasons else None


def repeats_exactly(df: DataFrame, plan: InsertPlan) -> bool:
    """Whether reading the input again surely gives the same rows, channels and verdicts.

    True for files, tables and ranges under filters and deterministic projections. A
    limit, an aggregate or a window may pick other rows when tasks finish in another
    order, a partitioned catalog table is listed anew by every job, and a join is dear
    to repeat, so those count as not repeating.
    """
    analyzed = with_helpers(df, plan)._jdf.queryExecution().analyzed()
    return analyzed.deterministic() and _only_repeating(analyzed)


def _only_repeating(node) -> bool:
    if node.nodeName() not in REPEATING_NODES:
        return False
    if node.nodeName() == "LogicalRelation":
        table = node.catalogTable()
        if table.isDefined() and not table.get().partitionColumnNames().isEmpty():
            return False
    children = node.children()
    return all(_only_repeating(children.apply(i)) for i in range(children.size()))


@dataclass
class Epoch:
    """What an epoch left behind."""

    writer: str
    epoch: int
    rows_failed: int = 0
    batches_failed: int = 0
    error: Exception | None = None
    assignments: DataFrame | None = None
    deadline: Deadline | None = None
    rows_stored: int | None = None

    def out_of_time(self) -> bool:
        return self.deadline is not None and self.deadline.passed


@dataclass(frozen=True)
class Verdict:
    """Batches of an epoch and how to find the rows of the failed ones."""

    rows: DataFrame
    batches: DataFrame
    failed: DataFrame | None
    link: list[str]
    rows_failed: int
    batches_failed: int
    numbered: DataFrame

    def accepted(self) -> DataFrame:
        return self._linked("left_anti") if self.failed is not None else self.rows

    def rejected(self) -> DataFrame:
        return self._linked("left_semi")

    def _linked(self, how: str) -> DataFrame:
        other = self.failed.select(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(self.link)])
        same = [F.col(c).eqNullSafe(F.col(f"_f{i}")) for i, c in enumerate(self.link)]
        return self.rows.join(other, same, how)


def insert_epoch(df: DataFrame, plan: InsertPlan, store: TableStore, writer: str, epoch: int,
                 evaluate_once: bool, scratch: str) -> Epoch:
    """Write one epoch, as a whole or channel by channel; running it again with the same rows
    replaces it. An epoch over the drain limit is cancelled and raises."""
    write = _insert_channels if plan.options.commit == "channel" else _insert_epoch
    done = Epoch(writer, epoch)
    if plan.options.drain_limit is None:
        return write(df, plan, store, done, evaluate_once, scratch)
    with Deadline(store.spark, plan.options.drain_limit) as done.deadline:
        try:
            return write(df, plan, store, done, evaluate_once, scratch)
        except Exception as e:
            if not done.out_of_time():
                raise
            committed = store.epochs("log")
            for name in store.writers("rows", writer):
                if (name, epoch) not in committed:
                    store.drop_epoch("rows", name, epoch)
            raise DrainLimitExceeded(
                f"epoch {epoch} of {writer} was not stored in {plan.options.drain_limit} s") from e


def _insert_epoch(df: DataFrame, plan: InsertPlan, store: TableStore, done: Epoch,
                  evaluate_once: bool, scratch: str) -> Epoch:
    started = time.monotonic()
    writer, epoch = done.writer, done.epoch
    # The log says that an epoch is complete, so it goes before the rows are touched.
    if storage.exists(store.spark, store.epoch_path("log", writer, epoch)):
        store.drop_epoch("log", writer, epoch)
    if plan.spec.primary_key:
        store.drop_epoch("marks", writer, epoch)
    rows = with_helpers(df, plan)
    if not plan.options.track_batches and _nothing_to_reject(df, plan, evaluate_once):
        batches = _insert_all(rows, plan, store, done, evaluate_once, scratch)
        _finish(batches, plan, store, done, started)
        return done

    verdict = _judge(rows, plan, evaluate_once, scratch)
    done.rows_failed, done.batches_failed = verdict.rows_failed, verdict.batches_failed
    if verdict.rows_failed and plan.options.on_failure == "fail":
        _write_results(plan, store, done, None, verdict.rejected())
        store.drop_epoch("rows", writer, epoch)
        raise InsertFailed(
            f"{verdict.batches_failed} batches with {verdict.rows_failed} rows were rejected",
            verdict.batches_failed, verdict.rows_failed)
    _write_rows(verdict.accepted(), plan, store, done)
    if done.error is not None:
        verdict = _salvaged(verdict, rows, plan, store, done, scratch)
    if done.error is None:
        _write_results(plan, store, done, verdict.accepted(),
                       verdict.rejected() if verdict.rows_failed else None)
    else:
        _write_results(plan, store, done, None, verdict.rows)
    _finish(verdict.batches, plan, store, done, started)
    if plan.options.track_batches:
        done.assignments = _assignments(verdict, plan, done)
    return done


def _finish(batches: DataFrame, plan: InsertPlan, store: TableStore, done: Epoch, started: float) -> None:
    """Write the log of the epoch, and beside it the index of its keys: marks without a log count
    for nothing, and an epoch with a log and no marks is indexed when it is met."""
    if not plan.options.dedupe_on_key or done.error is not None:
        _write_log(batches, store, done, started)
        return
    with ThreadPoolExecutor(1) as pool:
        index = pool.submit(inheritable_thread_target(store.spark)(index_epoch),
                            store, done.writer, done.epoch, done.rows_stored)
        _write_log(batches, store, done, started)
        index.result()


def _insert_channels(df: DataFrame, plan: InsertPlan, store: TableStore, done: Epoch,
                     evaluate_once: bool, scratch: str) -> Epoch:
    """Every channel is an epoch of a writer of its own, with a log of its own.

    A stream that runs an epoch again writes only the channels that did not commit. The log of the
    whole epoch, which has no batches, follows when every channel is done.
    """
    spark, folder = store.spark, f"{scratch}/channels"
    inputs = [quoted(n) for n in df.columns]
    df.select(*inputs, plan.channel.alias(CHANNEL)).write.mode("overwrite").partitionBy(CHANNEL).parquet(folder)
    channels = sorted(int(name.partition("=")[2]) for name in storage.children(spark, folder)
                      if name.startswith(f"{CHANNEL}="))
    if len(channels) > MOST_CHANNELS:
        raise OptionError(f"{len(channels)} channels; at most {MOST_CHANNELS} can commit apart")
    writers = {c: f"{done.writer}{CHANNEL_MARK}{c}" for c in channels}
    committed = {w for w, e in store.epochs("log") if e == done.epoch} if plan.streaming else set()
    for other in store.writers("log", done.writer):
        if other not in committed or other not in writers.values():
            for kind in KINDS:
                store.drop_epoch(kind, other, done.epoch)

    def write(channel: int) -> Epoch | Exception:
        one = Epoch(writers[channel], done.epoch, deadline=done.deadline)
        if one.writer in committed:
            return one
        rows = spark.read.schema(df.schema).parquet(f"{folder}/{CHANNEL}={channel}")
        try:
            return _insert_epoch(rows, plan, store, one, False, f"{scratch}/channel{channel}")
        except Exception as e:
            return e

    # Channels written at the same time would not see each other's keys.
    with ThreadPoolExecutor(1 if plan.options.dedupe_on_key else CHANNELS_AT_A_TIME) as pool:
        ends = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(write), c) for c in channels]]
    for end in ends:
        if isinstance(end, Exception):
            raise end
        done.rows_failed += end.rows_failed
        done.batches_failed += end.batches_failed
        done.error = done.error or end.error
    store.write_epoch("log", spark.createDataFrame([], LOG_SCHEMA), done.writer, done.epoch)
    return done


def _salvaged(verdict: Verdict | None, rows: DataFrame, plan: InsertPlan, store: TableStore, done: Epoch,
              scratch: str) -> Verdict:
    """After the rows of an epoch could not be stored: store what batches can be, in groups.

    Groups are first tried beside the epoch, many at a time. A trial names the batches that have a row
    which the writing task can't evaluate, so that the number of jobs does not grow with theirs; a group
    whose job fails all the same is split, down to single batches, so that a batch fails alone. Jobs that
    fail leave nothing. What passes is then stored by one job. Keys of one group decide what another
    stores, so with ``dedupe_on_key`` the groups are stored one after the other instead. When nothing
    was stored for ``DOWN_AFTER`` attempts, the store counts as down and the groups left fail as they are.
    """
    if verdict is None or BATCH not in verdict.rows.columns:
        verdict = _verdict(None, rows if verdict is None else verdict.rows, [CHANNEL, BATCH], plan,
                           f"{scratch}/salvage")
    placed = number_rows(verdict.batches.where("not failed").select(CHANNEL, BATCH), [], [CHANNEL, BATCH],
                         f"{scratch}/places").select(CHANNEL, BATCH, F.col(SEQ).alias("_place"))
    placed, _ = _written(placed, f"{scratch}/placed")
    n = placed.count()
    step = -(-n // SLICES) or 1
    good = (verdict.rows.join(placed, [CHANNEL, BATCH]).withColumn(PART, F.expr(f"_place div {step}"))
            .repartitionByRange("_place").sortWithinPartitions("_place"))
    good.write.mode("overwrite").partitionBy(PART).parquet(f"{scratch}/good")
    schema = good.schema
    good = store.spark.read.schema(schema).parquet(f"{scratch}/good")

    def within(low: int, high: int, copied: str | None = None) -> DataFrame:
        rows = good if copied is None else store.spark.read.schema(schema).parquet(copied)
        return rows.where((F.col("_place") >= low) & (F.col("_place") < high)
                          & F.col(PART).between(low // step, (high - 1) // step))

    store.drop_epoch("rows", done.writer, done.epoch)
    lost, refused, n_refused = [], None, 0
    if not plan.options.dedupe_on_key:
        refused, _ = _written(_failing(n, within, plan, store, done, scratch), f"{scratch}/refused")
        n_refused = refused.count()
    if n_refused:
        good = good.join(refused, "_place", "left_anti")
    todo, in_a_row = [(0, n)] if n_refused < n else [], 0
    stored = False
    while todo:
        low, high = todo.pop()
        try:
            store.write_epoch("rows", table_rows(within(low, high), plan, store, done, also_own=stored),
                              done.writer, done.epoch, mode="append")
            stored, in_a_row = True, 0
        except Exception as e:
            if done.out_of_time():
                raise
            in_a_row += 1
            log.error("batches %s to %s of epoch %s of %s were not stored: %s", low, high - 1, done.epoch, done.writer, e)
            if high - low == 1 or in_a_row > DOWN_AFTER:
                lost.append((low, high))
            else:
                todo += _split(low, high)
    if not stored:
        store.drop_epoch("rows", done.writer, done.epoch)
        return verdict
    done.error = None
    if not lost and not n_refused:
        return verdict
    places = _places(store.spark, lost)
    failed = placed.join((places.union(refused) if n_refused else places).distinct(), "_place")
    failed = failed.select(CHANNEL, BATCH).withColumn("_lost", F.lit(True))
    batches, totals = _written(
        verdict.batches.join(failed, [CHANNEL, BATCH], "left")
        .withColumn("failed", F.col("failed") | F.coalesce("_lost", F.lit(False))).drop("_lost"),
        f"{scratch}/judged", F.sum(F.when(F.col("failed"), F.col("n_rows"))).alias("rows"),
        F.count(F.when(F.col("failed"), 1)).alias("batches"))
    done.rows_failed, done.batches_failed = totals["rows"], totals["batches"]
    return replace(verdict, batches=batches, failed=batches.where("failed").select(CHANNEL, BATCH),
                   rows_failed=done.rows_failed, batches_failed=done.batches_failed)


def _split(low: int, high: int) -> list[tuple[int, int]]:
    step = -(-(high - low) // SPLIT)
    return [(k, min(k + step, high)) for k in reversed(range(low, high, step))]


def _places(spark, ranges: list[tuple[int, int]]) -> DataFrame:
    ranges = spark.createDataFrame(ranges, "low long, high long")
    return ranges.select(F.explode(F.sequence("low", F.col("high") - 1)).alias("_place"))


def _failing(n: int, within, plan: InsertPlan, store: TableStore, done: Epoch, scratch: str) -> DataFrame:
    """Places, of 0 to n, of the batches that can't be stored; when the store is down, of what is left.

    Every group is written as an epoch of a writer of its own, which has no log, and dropped again.
    Groups lie one behind the other on a stack, so that few are open, however many batches there are.
    The batches that a trial names are copied, as the driver may not hold their places, and tried again
    by themselves, as often as a group can be split, as an error may pass.
    """
    spark = store.spark
    schema = T.StructType([T.StructField("_place", T.LongType())])

    def places_in(folder: str) -> DataFrame:
        return spark.read.schema(schema).parquet(folder)

    def kept(low: int, high: int, size: int) -> str:
        return f"{scratch}/{'lost' if size == 1 else f'named{size}'}/{low}-{high}"

    def named(low: int, high: int, size: int, among: str | None, copied: str | None) -> int | Exception:
        writer = f"{done.writer}{TRIAL_MARK}{low}-{high}"
        rows = within(low, high, copied)
        if among is not None:
            rows = rows.join(places_in(among), "_place", "left_semi")
        try:
            trial = table_rows(rows.withColumn(PART, F.col("_place")), plan, store, done, trial=True)
            store.write_epoch("rows", trial, writer, done.epoch)
            found, totals = _written(store.refused(writer, done.epoch), kept(low, high, size), F.count(F.lit(1)).alias("n"))
            if totals["n"] and size > 1 and copied is None:
                _written(rows.join(found, "_place", "left_semi"), f"{scratch}/again/{low}-{high}")
            return totals["n"]
        except Exception as e:
            return e
        finally:
            store.drop_epoch("tries", writer, done.epoch)

    # A group: the places from low to high, the size of what it was split into, and, once some of them
    # were named, the folders of these and of a copy of their rows.
    todo, running, lost, in_a_row = [], {}, [], 0
    if n > 1:
        todo = [(low, high, high - low, None, None) for low, high in _split(0, n)]
    with ThreadPoolExecutor(TRIES_AT_A_TIME) as pool:
        while todo or running:
            while todo and len(running) < TRIES_AT_A_TIME:
                group = todo.pop()
                running[pool.submit(inheritable_thread_target(spark)(named), *group)] = group
            for ended in wait(running, return_when=FIRST_COMPLETED).done:
                low, high, size, among, copied = running.pop(ended)
                found, smaller = ended.result(), -(-size // SPLIT)
                if not isinstance(found, Exception):
                    in_a_row = 0
                    if found:
                        log.error("%s of batches %s to %s of epoch %s of %s can't be written", found, low, high - 1, done.epoch, done.writer)
                        if size > 1:
                            todo.append((low, high, smaller, kept(low, high, size), copied or f"{scratch}/again/{low}-{high}"))
                    continue
                if done.out_of_time():
                    raise found
                in_a_row += 1
                log.error("batches %s to %s of epoch %s of %s were not stored: %s", low, high - 1, done.epoch, done.writer, found)
                if high - low > 1 and in_a_row <= DOWN_AFTER * TRIES_AT_A_TIME:
                    todo += [(*part, smaller, among, copied) for part in _split(low, high)]
                elif among is None:
                    lost.append((low, high))
                else:
                    _written(places_in(among).where(F.col("_place").between(low, high - 1)), kept(low, high, 1))
    places = _places(spark, lost)
    if storage.exists(spark, f"{scratch}/lost"):
        places = places.union(places_in(f"{scratch}/lost/*"))
    return places


def _nothing_to_reject(df: DataFrame, plan: InsertPlan, evaluate_once: bool) -> bool:
    """Whether the verdict can be skipped.

    Without an order a verdict needs a copy of the rows, so it pays to look for a bad
    row first: the scan reads the tested columns only and stops at the first hit, and
    NULL tests are answered from file statistics.
    """
    if plan.bad is None:
        return True
    if evaluate_once or plan.options.order_columns:
        return False
    return df.where(plan.bad).select(F.lit(1)).isEmpty()


def with_helpers(df: DataFrame, plan: InsertPlan) -> DataFrame:
    """The input with its channel, verdict and order columns."""
    order = plan.options.order_columns
    bad = F.lit(False) if plan.bad is None else plan.bad
    return df.select(*map(quoted, df.columns), plan.channel.alias(CHANNEL), bad.alias(BAD),
                     *[F.expr(o).alias(n) for o, n in zip(order, order_names(order))])


def _insert_all(rows: DataFrame, plan: InsertPlan, store: TableStore, done: Epoch,
                evaluate_once: bool, scratch: str) -> DataFrame:
    """Write every row; the batches are then read off the written rows where possible."""
    order = order_names(plan.options.order_columns)
    shown = None if plan.options.dedupe_on_key else _stored_order(plan)
    reads_again = shown is None or (plan.stores_all_results and plan.options.results)
    if evaluate_once and reads_again:
        rows, _ = _written(rows, f"{scratch}/input")
    _write_rows(rows, plan, store, done)
    if done.error is not None:
        verdict = _salvaged(None, rows, plan, store, done, scratch)
        if done.error is None:
            _write_results(plan, store, done, verdict.accepted(),
                           verdict.rejected() if verdict.rows_failed else None)
        else:
            _write_results(plan, store, done, None, rows)
        return verdict.batches
    _write_results(plan, store, done, rows, None)

    counted = rows.withColumn(PART, F.spark_partition_id())
    if shown is not None:
        counted = store.epoch_rows(done.writer, done.epoch)
        counted = counted.select(CHANNEL, PART, *[quoted(t).alias(n) for t, n in zip(shown, order)])
    if not order:
        return batches_from_counts(arrival_offsets(counted), plan.batch_size)
    narrow = counted.select(CHANNEL, F.lit(False).alias(BAD), *order)
    numbered = number_staged(stage(narrow, [CHANNEL], order, f"{scratch}/rows"),
                             [CHANNEL], f"{scratch}/offsets")
    return summarise_batches(with_batch_numbers(numbered, plan.batch_size), order)


def _stored_order(plan: InsertPlan) -> list[str] | None:
    """Table columns that hold the order unchanged, or None if it is not stored."""
    unchanged = {c.source: c.target for c in plan.columns if c.lossless}
    order = plan.options.order_columns
    return [unchanged[o] for o in order] if all(o in unchanged for o in order) else None


def _judge(rows: DataFrame, plan: InsertPlan, evaluate_once: bool, scratch: str) -> Verdict:
    order = order_names(plan.options.order_columns)
    if order:
        if evaluate_once:
            rows, _ = _written(rows, f"{scratch}/input")
        verdict = _verdict(rows, rows.select(CHANNEL, BAD, *order), [CHANNEL, *order], plan,
                           f"{scratch}/keys")
        if verdict.failed is None or not _key_straddles(verdict, order):
            return verdict
        log.warning("order_by is not unique where a failed batch ends; numbering whole rows")
    return _verdict(None, rows, [CHANNEL, BATCH], plan, f"{scratch}/whole")


def _verdict(rows: DataFrame | None, to_number: DataFrame, link: list[str], plan: InsertPlan,
             scratch: str) -> Verdict:
    order = order_names(plan.options.order_columns)
    staged = stage(to_number, [CHANNEL], order, f"{scratch}/rows")
    numbered = with_batch_numbers(
        number_staged(staged, [CHANNEL], f"{scratch}/offsets"), plan.batch_size)
    batches, totals = _written(
        summarise_batches(numbered, order), f"{scratch}/batches",
        F.sum(F.when(F.col("failed"), F.col("n_rows"))).alias("rows"),
        F.count(F.when(F.col("failed"), 1)).alias("batches"))
    rows_failed, batches_failed = totals.get("rows") or 0, totals.get("batches") or 0
    failed = None
    if rows_failed:
        failed_batches = batches.where("failed").select(CHANNEL, BATCH)
        if rows is not None:
            members = numbered.join(failed_batches, [CHANNEL, BATCH], "left_semi")
            members = members.select(*link).distinct()
        else:
            members = failed_batches
        # Written so that the planner sees its size and broadcasts it only when small;
        # as sorted keys compress well, their number is bounded too.
        failed, _ = _written(members, f"{scratch}/failed")
        if (rows_failed if rows is not None else batches_failed) > BROADCAST_ROWS:
            failed = failed.hint("merge")
    return Verdict(numbered if rows is None else rows, batches, failed, link,
                   rows_failed, batches_failed, numbered)


def _written(df: DataFrame, path: str, *observed: Column):
    """``df`` read back from where it was written, and the observed totals."""
    if observed:
        seen = Observation()
        df = df.observe(seen, *observed)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get if observed else {}


def _key_straddles(verdict: Verdict, order: list[str]) -> bool:
    """Whether rows of one order key lie in a failed and in an accepted batch."""
    bounds = verdict.batches.select(CHANNEL, BATCH, "lo", "hi", "failed")
    after = bounds.select(CHANNEL, (F.col(BATCH) - 1).alias(BATCH), F.col("lo").alias("next_lo"),
                          F.col("failed").alias("next_failed"))
    shared = bounds.join(after, [CHANNEL, BATCH]).where(
        F.col("hi").eqNullSafe(F.col("next_lo")) & (F.col("failed") != F.col("next_failed")))
    return not shared.isEmpty()


def table_rows(rows: DataFrame, plan: InsertPlan, store: TableStore, done: Epoch,
               also_own: bool = False, trial: bool = False) -> DataFrame:
    """What is written for the accepted rows: converted, laid out, with helper columns.

    ``also_own``: rows of this epoch are stored already, whose keys count too.
    ``trial``: the rows have a ``_part``, which they keep.
    """
    order = tuple(order_names(plan.options.order_columns))
    converted = conform(rows, plan.columns, (CHANNEL, *order, *([PART] if trial else [])))
    if plan.options.dedupe_on_key:
        keys = list(plan.spec.primary_key)
        converted = without_stored_keys(first_per_key(converted, keys, list(order)), converted,
                                        store, keys, done.writer, done.epoch)
        if also_own:
            own = store.epoch_rows(done.writer, done.epoch).select(*map(quoted, keys))
            converted = anti_join(converted, own.toDF(*key_names(keys)), keys)
    laid_out = lay_out(converted.drop(*order), plan.spec)
    return laid_out.select(*map(quoted, plan.spec.schema.fieldNames()), CHANNEL,
                           F.col(PART) if trial else F.spark_partition_id().alias(PART), SHARD)


def _write_rows(rows: DataFrame, plan: InsertPlan, store: TableStore, done: Epoch) -> None:
    seen = Observation() if plan.options.dedupe_on_key else None
    try:
        written = table_rows(rows, plan, store, done)
        if seen is not None:
            written = written.observe(seen, F.count(F.lit(1)).alias("n"))
        store.write_epoch("rows", written, done.writer, done.epoch)
        done.rows_stored = seen.get["n"] if seen is not None else None
    except Exception as e:
        # A stream runs the epoch again; offsets of rows that were not stored must not be committed.
        if plan.options.on_failure == "fail" or plan.streaming or done.out_of_time():
            raise
        log.error("epoch %s of %s was not written: %s", done.epoch, done.writer, e)
        store.drop_epoch("rows", done.writer, done.epoch)
        done.error = e


def _write_results(plan: InsertPlan, store: TableStore, done: Epoch, accepted: DataFrame | None,
                   rejected: DataFrame | None) -> None:
    """Rejected rows as they came; accepted ones too if the table cannot show them."""
    if not plan.options.results:
        return
    inputs = [quoted(n) for n in plan.input_schema.fieldNames()]
    parts = []
    if accepted is not None and plan.stores_all_results:
        parts.append(accepted.select(*inputs, F.lit(True).alias(INSERTED)))
    if rejected is not None:
        parts.append(rejected.select(*inputs, F.lit(False).alias(INSERTED)))
    if parts:
        store.write_epoch("results", reduce(DataFrame.unionByName, parts), done.writer, done.epoch)
    else:
        store.drop_epoch("results", done.writer, done.epoch)


def _write_log(batches: DataFrame, store: TableStore, done: Epoch, started: float) -> None:
    elapsed = int((time.monotonic() - started) * 1000)
    lines = log_from_batches(batches, elapsed, all_failed=done.error is not None)
    store.write_epoch("log", lines, done.writer, done.epoch)


def _assignments(verdict: Verdict, plan: InsertPlan, done: Epoch) -> DataFrame:
    """Order columns, channel, batch and outcome of every row of the epoch."""
    order = plan.options.order_columns
    named = [F.col(n).alias(o if o in plan.input_schema.names else n)
             for o, n in zip(order, order_names(order))]
    inputs = [] if named else [quoted(n) for n in plan.input_schema.names]
    outcome = verdict.batches.select(
        CHANNEL, BATCH, (F.lit(done.error is None) & ~F.col("failed")).alias(INSERTED))
    return (verdict.numbered.join(outcome, [CHANNEL, BATCH])
            .select(*named, *inputs, F.col(CHANNEL).alias("channel"),
                    F.col(BATCH).alias("batch_no"), INSERTED))


class InsertResult:
    """Handles on what an insert did; everything is read when asked for."""

    def __init__(self, plan: InsertPlan, store: TableStore, writer: str, epoch: int | None,
                 outcome: Epoch | None = None, scratch: str | None = None, query=None):
        self.plan, self.store, self.writer, self.epoch = plan, store, writer, epoch
        self.outcome, self.query, self._scratch = outcome, query, scratch

    @property
    def rows(self) -> DataFrame:
        """Accepted rows of this insert, as stored."""
        names = self.plan.spec.schema.fieldNames()
        return self.store.stored_rows(self.writer, self.epoch).select(*map(quoted, names))

    @property
    def results(self) -> DataFrame:
        """Every input row with its ``_Inserted_`` flag."""
        if not self.plan.options.results:
            raise IngestError("this insert was asked for no results")
        fields = self.plan.input_schema.fields
        kept = self.store.results(self.plan.input_schema, self.writer, self.epoch)
        kept = kept.select(*[quoted(f.name) for f in fields], INSERTED)
        if self.plan.stores_all_results:
            return kept
        by_source = {c.source: c for c in self.plan.columns}
        shown = [quoted(by_source[f.name].target).cast(f.dataType).alias(f.name) for f in fields]
        return self.rows.select(*shown, F.lit(True).alias(INSERTED)).unionByName(kept)

    @property
    def log(self) -> DataFrame:
        """One row per batch."""
        return self.store.log(self.writer, self.epoch)

    @property
    def assignments(self) -> DataFrame:
        """The batch of every row; needs ``track_batches``."""
        if self.outcome is None or self.outcome.assignments is None:
            raise IngestError("batches of single rows are kept with track_batches=True only")
        return self.outcome.assignments

    @property
    def metrics(self) -> dict:
        """Totals over the log: batches and rows, written and failed."""
        rows, ok = F.col("n_rows"), F.col("ok")
        totals = self.log.agg(
            F.count(F.when(ok, 1)).alias("n_write_successes"),
            F.count(F.when(~ok, 1)).alias("n_write_failures"),
            F.coalesce(F.sum(F.when(ok, rows)), F.lit(0)).alias("rows_ok"),
            F.coalesce(F.sum(F.when(~ok, rows)), F.lit(0)).alias("rows_failed"))
        return totals.first().asDict()

    def await_termination(self, timeout: float | None = None):
        """Wait for a streaming insert; a bounded trigger ends by itself."""
        return self.query.awaitTermination(timeout) if self.query is not None else True

    def release(self) -> None:
        """Delete the scratch data behind ``assignments``."""
        if self._scratch is not None:
            storage.remove(self.store.spark, self._scratch)
            self._scratch = None


class DryRunResult:
    """Outcome of an insert that converts every row and writes none."""

    def __init__(self, df: DataFrame, plan: InsertPlan, rows_converted: int):
        self._df, self.plan = df, plan
        self._rows_converted = rows_converted

    @property
    def results(self) -> DataFrame:
        return self._df.withColumn(INSERTED, F.lit(True))

    @property
    def log(self) -> DataFrame:
        placed = self._df.select(
            self.plan.channel.alias(CHANNEL), F.spark_partition_id().alias(PART))
        return log_from_batches(
            batches_from_counts(arrival_offsets(placed), self.plan.batch_size), 0)

    @property
    def metrics(self) -> dict:
        return {"rows_converted": self._rows_converted, "rows_written": 0}


def dry_run(df: DataFrame, plan: InsertPlan) -> DryRunResult:
    seen = Observation()
    converted = conform(df, plan.columns).observe(seen, F.count(F.lit(1)).alias("n"))
    converted.write.format("noop").mode("overwrite").save()
    return DryRunResult(df, plan, seen.get["n"])


def insert_batch(df: DataFrame, options: InsertOptions, store: TableStore | None = None):
    """``store``: where to write, in place of the target that the options name."""
    spark = df.sparkSession
    if options.dry_run:
        return dry_run(df, plan_insert(df, options, None))
    store = store or TableStore(spark, table=options.table, database=options.database, path=options.path)
    plan = plan_insert(df, options, store)
    # Inserts that run at the same time must not meet in one epoch, so each has a writer of its
    # own unless it names one, or an epoch that is meant to be replaced.
    named = BATCH_WRITER if options.epoch is not None else f"{BATCH_WRITER}-{uuid.uuid4().hex}"
    writer = options.writer or named
    epoch = store.next_epoch(writer) if options.epoch is None else options.epoch
    once = not repeats_exactly(df, plan) if options.evaluate_once is None else options.evaluate_once
    scratch = storage.scratch_path(spark, "insert")
    keep = False
    try:
        outcome = insert_epoch(df, plan, store, writer, epoch, once, scratch)
        keep = outcome.assignments is not None
        return InsertResult(plan, store, writer, epoch, outcome, scratch if keep else None)
    finally:
        if not keep:
            storage.remove(spark, scratch)
