"""Streaming inserts: epochs, flush, restart, replay and refusals."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

import tidegate as tg
from tidegate.errors import OptionError
from tidegate.sources.counters import counter_stream, sample_stream
from tidegate.streaming.stream import trigger_arguments, writer_of

SCHEMA = "id bigint, v string"


@pytest.fixture
def feed(spark, tmp_path):
    """A folder that files of rows are dropped into, read as a stream."""
    folder = tmp_path / "feed"
    folder.mkdir()

    def add(first, last):
        (spark.range(first, last).select("id", F.lit("x").alias("v")).coalesce(1)
         .write.mode("append").parquet(str(folder)))

    def stream(files=1):
        return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files)
                .parquet(str(folder)))

    add.stream = stream
    return add


def run(stream, target, **options):
    done = tg.insert(stream, path=target, checkpoint=f"{target}-cp", trigger="availableNow", **options)
    done.await_termination()
    return done


def test_flush_at_end_of_stream(spark, feed, target):
    feed(0, 105)
    done = run(feed.stream(), target, batch_size=50, order_by="id")
    assert sorted(r.n_rows for r in done.log.collect()) == [5, 50, 50]
    assert done.results.where("_Inserted_").count() == 105


def test_every_epoch_is_flushed(spark, feed, target):
    feed(0, 30)
    feed(30, 60)
    done = run(feed.stream(), target, batch_size=20, order_by="id")
    log = [(r._epoch, r.batch_no, r.n_rows) for r in done.log.collect()]
    assert sorted(log) == [(0, 0, 20), (0, 1, 10), (1, 0, 20), (1, 1, 10)]
    assert done.rows.count() == 60


def test_restart_continues_and_keeps_counting(spark, feed, target):
    feed(0, 30)
    assert run(feed.stream(), target, batch_size=20).metrics["rows_ok"] == 30
    feed(30, 70)
    done = run(feed.stream(), target, batch_size=20)
    assert done.metrics == {"n_write_successes": 4, "n_write_failures": 0, "rows_ok": 70, "rows_failed": 0}
    assert run(feed.stream(), target).metrics["rows_ok"] == 70        # nothing new
    assert tg.read_table(spark, path=target).select("id").distinct().count() == 70


@pytest.mark.parametrize("evaluate_once", [None, False])
@pytest.mark.parametrize("order_by", [None, "id"])
def test_verdicts_in_a_stream(spark, feed, target, evaluate_once, order_by):
    feed(0, 30)
    feed(30, 60)
    done = run(feed.stream(), target, batch_size=10, order_by=order_by, reject_when="id = 42",
               evaluate_once=evaluate_once)
    assert done.metrics == {"n_write_successes": 5, "n_write_failures": 1, "rows_ok": 50, "rows_failed": 10}
    flags = {r.id: r._Inserted_ for r in done.results.collect()}
    assert len(flags) == 60 and sum(flags.values()) == 50 and flags[42] is False


@pytest.mark.parametrize("catalog", [False, True])
def test_crash_between_write_and_commit(spark, feed, target, name, catalog):
    feed(0, 105)
    where = {"table": name} if catalog else {"path": target}
    options = {**where, "checkpoint": f"{target}-cp", "batch_size": 50, "order_by": "id"}
    writer = tg.epoch_writer(feed.stream(), **options)

    def write_then_fail(batch, epoch):
        writer(batch, epoch)
        raise RuntimeError("crash")

    query = (feed.stream().writeStream.foreachBatch(write_then_fail)
             .option("checkpointLocation", f"{target}-cp").trigger(availableNow=True).start())
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    assert tg.read_table(spark, **where).count() == 105
    done = tg.insert(feed.stream(), trigger="availableNow", **options)
    done.await_termination()
    assert done.rows.count() == 105 and done.metrics["n_write_successes"] == 3
    assert tg.read_table(spark, **where).count() == 105


def test_fail_policy_stops_the_stream_and_the_replay_heals(spark, feed, target):
    feed(0, 30)
    feed(30, 60)
    with pytest.raises(StreamingQueryException, match="InsertFailed"):
        run(feed.stream(), target, batch_size=10, on_failure="fail", reject_when="id = 42")
    rows = tg.read_table(spark, path=target)
    assert rows.count() == 30                        # the first epoch stays
    done = run(feed.stream(), target, batch_size=10, on_failure="fail", reject_when="id < 0")
    assert done.rows.count() == 60 and done.results.where("not _Inserted_").count() == 0


def test_forced_resets_lose_and_repeat_nothing(spark, feed, target):
    for start in range(0, 8000, 2000):
        feed(start, start + 2000)
    options = {"path": target, "checkpoint": f"{target}-cp", "schema": "int64 id, rstring val"}
    writer = tg.epoch_writer(feed.stream(), **options)
    for crash_at in (1, 2):
        def write_then_maybe_fail(batch, epoch, crash_at=crash_at):
            writer(batch, epoch)
            if epoch == crash_at:
                raise RuntimeError("reset")

        query = (feed.stream().writeStream.foreachBatch(write_then_maybe_fail)
                 .option("checkpointLocation", f"{target}-cp").trigger(availableNow=True).start())
        with pytest.raises(StreamingQueryException):
            query.awaitTermination()
    done = tg.insert(feed.stream(), trigger="availableNow", **options)
    done.await_termination()
    assert done.rows.count() == 8000 and done.rows.select("id").distinct().count() == 8000


def test_streams_and_batches_do_not_overwrite_each_other(spark, feed, target):
    feed(0, 10)
    tg.insert(spark.range(100, 105).select("id", F.lit("x").alias("v")), path=target)
    run(feed.stream(), target)
    other = tg.insert(feed.stream(), path=target, checkpoint=f"{target}-cp2", trigger="availableNow")
    other.await_termination()
    assert tg.read_table(spark, path=target).count() == 25


@pytest.mark.parametrize("catalog", [False, True])
def test_upstream_redelivery_with_keys(spark, feed, target, name, catalog):
    feed(0, 30)
    feed(10, 40)
    where = {"table": name} if catalog else {"path": target}
    done = tg.insert(feed.stream(), primary_key="id", dedupe_on_key=True, batch_size=10, order_by="id",
                     shards=3, checkpoint=f"{target}-cp", trigger="availableNow", **where)
    done.await_termination()
    assert sorted(r.id for r in tg.read_table(spark, **where).collect()) == list(range(40))
    assert done.results.where("_Inserted_").count() == 60
    assert done.metrics["rows_ok"] == 60


def test_back_to_the_initial_state(spark, feed, target):
    feed(0, 10)
    run(feed.stream(), target)
    tg.forget(spark, path=target, checkpoint=f"{target}-cp")
    assert tg.read_table(spark, path=target).count() == 0
    done = tg.insert(feed.stream(), path=target, checkpoint=f"{target}-cp", trigger="availableNow")
    done.await_termination()
    assert done.metrics["rows_ok"] == 10
    assert tg.read_table(spark, path=target).count() == 10


def test_a_checkpoint_made_anew_keeps_what_is_stored(spark, feed, target):
    from tidegate import storage

    feed(0, 10)
    run(feed.stream(), target)
    storage.remove(spark, f"{target}-cp")
    feed(10, 12)
    run(feed.stream(), target)
    # The new stream reads all its input; nothing of the old one is replaced.
    assert tg.read_table(spark, path=target).count() == 22


def test_dry_run_of_a_stream(spark, feed, target):
    feed(0, 105)
    done = run(feed.stream(), target, dry_run=True)
    assert done.metrics == {"rows_converted": 105, "rows_written": 0}


def test_unbounded_counter_with_a_time_trigger(spark, target):
    stream = sample_stream(counter_stream(spark, rows_per_batch=100))
    done = tg.insert(stream, path=target, schema="int32 id, int64 id2, rstring name", channels=3,
                     batch_size=100, primary_key="id", partitioning_key="id",
                     checkpoint=f"{target}-cp", trigger="1 second")
    deadline = time.time() + 60
    while time.time() < deadline and len(done.query.recentProgress) < 3:
        time.sleep(0.5)
    done.query.stop()
    ids = [r.id for r in tg.read_table(spark, path=target, committed_only=True).collect()]
    assert len(ids) >= 200 and sorted(ids) == list(range(len(ids)))


def test_triggers():
    assert trigger_arguments(None) == {}
    assert trigger_arguments("availableNow") == {"availableNow": True}
    assert trigger_arguments("5 seconds") == {"processingTime": "5 seconds"}
    assert trigger_arguments({"processingTime": "1 minute"}) == {"processingTime": "1 minute"}
    for refused in ({"continuous": "1 second"}, {"once": True}, {}, 5,
                    {"availableNow": True, "processingTime": "1 second"}):
        with pytest.raises(OptionError):
            trigger_arguments(refused)


def test_configuration_errors_come_before_the_stream_starts(spark, feed, target):
    feed(0, 1)
    for wrong in ({}, {"checkpoint": "c", "trigger": {"continuous": "1 second"}},
                  {"checkpoint": "c", "track_batches": True}, {"checkpoint": "c", "epoch": 3}):
        with pytest.raises(OptionError):
            tg.insert(feed.stream(), path=target, **wrong)
    with pytest.raises(OptionError, match="checkpoint"):
        tg.epoch_writer(feed.stream(), path=target)
    assert spark.streams.active == []


def test_a_checkpoint_names_its_writer():
    assert writer_of("/a/b") == writer_of("/a/b/") != writer_of("/a/c")
