"""Storage errors, channels that commit apart, and the drain limit."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

import tidegate as tg
from tidegate.errors import DrainLimitExceeded, OptionError
from tidegate.operators import sink
from tidegate.sources.tables import TableStore

SCHEMA = "id bigint, v string"


@pytest.fixture
def refuse(monkeypatch):
    """The writing tasks of the rows that a predicate names fail, as often as ``times`` says."""
    made = sink.table_rows

    def install(predicate, times=10**9):
        left = [times]

        def failing(rows, plan, store, done, **more):
            out = made(rows, plan, store, done, **more)
            if left[0] <= 0:
                return out
            left[0] -= 1
            first = out.columns[0]
            broken = F.when(F.expr(predicate), F.raise_error(F.lit("disk gone")).cast(out.schema[first].dataType))
            return out.withColumn(first, broken.otherwise(F.col(first)))

        monkeypatch.setattr(sink, "table_rows", failing)
    return install


@pytest.mark.parametrize("options", [
    {}, {"order_by": "id", "evaluate_once": True}, {"order_by": "id", "reject_when": "id = 3"},
    {"reject_when": "id = 3"}])
def test_a_batch_that_cannot_be_stored_fails_alone(spark, target, refuse, options):
    refuse("id in (37, 38, 81)")
    done = tg.insert(spark.range(100).coalesce(1), path=target, batch_size=10, **options)
    lost = {3, 8} | ({0} if "reject_when" in options else set())
    assert {r.batch_no: r.ok for r in done.log.collect()} == {b: b not in lost for b in range(10)}
    flags = {r.id: r._Inserted_ for r in done.results.collect()}
    assert flags == {i: i // 10 not in lost for i in range(100)}
    assert sorted(r.id for r in done.rows.collect()) == [i for i in range(100) if i // 10 not in lost]
    assert (done.outcome.batches_failed, done.outcome.rows_failed) == (len(lost), 10 * len(lost))
    assert done.outcome.error is None


@pytest.mark.parametrize("catalog", [False, True])
def test_groups_are_tried_beside_the_epoch_and_stored_by_one_job(spark, target, name, refuse, monkeypatch, catalog):
    refuse("id % 700 = 37")
    jobs, running, most, write = [], [], [0], TableStore.write_epoch

    def counted(self, kind, df, writer, epoch, mode="overwrite"):
        if kind != "rows":
            return write(self, kind, df, writer, epoch, mode)
        jobs.append(writer)
        running.append(writer)
        most[0] = max(most[0], len(running))
        try:
            return write(self, kind, df, writer, epoch, mode)
        finally:
            running.remove(writer)

    monkeypatch.setattr(TableStore, "write_epoch", counted)
    where = {"table": name} if catalog else {"path": target}
    done = tg.insert(spark.range(2000), batch_size=10, order_by="id", **where)
    lost = {37 // 10, 737 // 10, 1437 // 10}
    assert {r.batch_no for r in done.log.where("not ok").collect()} == lost
    assert jobs.count(done.writer) == 2 and most[0] > 1
    stored = sorted(r.id for r in tg.read_table(spark, **where).collect())
    assert stored == [i for i in range(2000) if i // 10 not in lost]
    assert {r._writer for r in done.store.stored_rows().select("_writer").collect()} == {done.writer}


@pytest.fixture
def row_writes(monkeypatch):
    """Writers of the rows written so far; writes of the places that ``broken`` holds fail, whatever the rows."""
    class Writes(list):
        broken = ()

    writes, write = Writes(), TableStore.write_epoch

    def counted(self, kind, df, writer, epoch, mode="overwrite"):
        if kind == "rows":
            writes.append(writer)
            low, _, high = writer.rpartition(".c.")[2].partition("-")
            if ".c." in writer and any(int(low) <= place < int(high) for place in writes.broken):
                raise OSError("disk gone")
        return write(self, kind, df, writer, epoch, mode)

    monkeypatch.setattr(TableStore, "write_epoch", counted)
    return writes


@pytest.mark.parametrize("catalog", [False, True])
def test_writes_do_not_grow_with_the_batches_that_are_refused(spark, target, name, refuse, row_writes, catalog):
    refuse("id % 50 = 37")
    where = {"table": name} if catalog else {"path": target}
    done = tg.insert(spark.range(5000), batch_size=10, order_by="id", **where)
    lost = {b for b in range(500) if b % 5 == 3}
    assert {r.batch_no for r in done.log.where("not ok").collect()} == lost
    assert sorted(r.id for r in tg.read_table(spark, **where).collect()) == [i for i in range(5000) if i // 10 not in lost]
    assert {r.id for r in done.results.where("not _Inserted_").collect()} == {i for i in range(5000) if i // 10 in lost}
    assert done.outcome.error is None and done.outcome.rows_failed == 1000
    # The epoch twice, and 8 groups as often as 500 batches can be split by 8.
    assert len(row_writes) <= 2 + 8 * 3


def test_what_a_trial_writes_is_no_row_of_the_table(spark, target, refuse, monkeypatch):
    refuse("id % 100 = 37")
    seen, refused = [], TableStore.refused

    def look(self, writer, epoch):
        seen.append((tg.read_table(spark, path=target).count(), self.stored_rows(writer, epoch).count()))
        return refused(self, writer, epoch)

    monkeypatch.setattr(TableStore, "refused", look)
    done = tg.insert(spark.range(1000), path=target, batch_size=10, order_by="id", epoch=0)
    assert seen and set(seen) == {(0, 0)}
    assert done.rows.count() == 900
    tg.forget(spark, path=target, writer="batch")
    assert tg.read_table(spark, path=target).count() == 0


def test_a_group_whose_job_fails_is_split_and_others_name_their_batches(spark, target, refuse, row_writes):
    refuse("id % 100 = 37")
    row_writes.broken = (0, 33, 58)         # 33 is also refused for a row
    done = tg.insert(spark.range(1000), path=target, batch_size=10, order_by="id")
    lost = {b for b in range(100) if b % 10 == 3} | {0, 58}
    assert {r.batch_no for r in done.log.where("not ok").collect()} == lost
    assert sorted(r.id for r in done.rows.collect()) == [i for i in range(1000) if i // 10 not in lost]


def test_rows_that_fail_before_the_last_step_of_the_write(spark, target, refuse, monkeypatch):
    refuse("id in (37, 81)")
    failing = sink.table_rows
    # The rows are shuffled after they failed, where a trial can't name them: groups are split.
    monkeypatch.setattr(sink, "table_rows", lambda *a, **more: failing(*a, **more).repartition(2))
    done = tg.insert(spark.range(100), path=target, batch_size=10, order_by="id")
    assert {r.batch_no for r in done.log.where("not ok").collect()} == {3, 8}
    assert sorted(r.id for r in done.rows.collect()) == [i for i in range(100) if i // 10 not in (3, 8)]


def test_batches_that_the_store_takes_later_are_stored(spark, target, refuse):
    refuse("id % 100 = 37", times=1 + 8 + 8)    # the epoch and two trials of eight groups
    done = tg.insert(spark.range(5000), path=target, batch_size=10, order_by="id")
    assert done.rows.count() == 5000 and done.log.where("not ok").isEmpty()


def test_trials_of_columns_with_odd_names(spark, target, refuse):
    refuse("`a.b` = 37")
    rows = spark.range(100).selectExpr("id a", "cast(null as string) n", "id b", "id c")
    done = tg.insert(rows, path=target, batch_size=10, order_by="a", channels="a % 2", schema=[
        ("_place", "int64"), ("_row", "optional<rstring>"), ("a.b", "int64"), ("x y", "int64")])
    lost = set(range(21, 40, 2))
    assert sorted(r[0] for r in done.rows.collect()) == [i for i in range(100) if i not in lost]


def test_batches_of_several_channels_in_a_catalog_table(spark, name, refuse):
    refuse("id = 40")
    done = tg.insert(spark.range(100), name, batch_size=7, channels="id % 3", order_by="id")
    members = [i for i in range(100) if i % 3 == 1]
    lost = members[(members.index(40) // 7) * 7:][:7]
    assert sorted(r.id for r in spark.table(name).collect()) == [i for i in range(100) if i not in lost]
    assert [(r.channel, r.batch_no) for r in done.log.where("not ok").collect()] == [(1, members.index(40) // 7)]


def test_groups_fail_as_they_are_when_the_store_is_down(spark, target, refuse, monkeypatch):
    monkeypatch.setattr(sink, "DOWN_AFTER", 3)
    refuse("id >= 0")
    done = tg.insert(spark.range(640), path=target, batch_size=10, order_by="id")
    assert done.outcome.error is not None
    assert done.metrics["rows_failed"] == 640 and done.results.where("_Inserted_").count() == 0
    assert tg.read_table(spark, path=target).count() == 0


def test_keys_stored_by_one_group_are_not_stored_by_the_next(spark, target, refuse):
    refuse("id = 55")
    rows = spark.range(100).select((F.col("id") % 60).alias("id"), F.col("id").alias("o"))
    done = tg.insert(rows, path=target, batch_size=10, order_by="o", primary_key="id", dedupe_on_key=True)
    stored = sorted(r.id for r in done.rows.collect())
    assert stored == [i for i in range(60) if not 50 <= i < 60]


def test_channels_commit_apart(spark, target, refuse):
    options = {"path": target, "channels": "id % 4", "order_by": "id", "batch_size": 10, "commit": "channel"}
    done = tg.insert(spark.range(200), **options)
    whole = tg.insert(spark.range(200), **{**options, "path": f"{target}-whole", "commit": "epoch"})
    columns = ["channel", "batch_no", "n_rows", "order_lo", "order_hi", "ok"]
    assert sorted(map(tuple, done.log.select(*columns).collect())) == sorted(map(tuple, whole.log.select(*columns).collect()))
    assert sorted(r.id for r in done.rows.collect()) == list(range(200))
    assert done.results.where("_Inserted_").count() == 200
    assert tg.read_table(spark, path=target, committed_only=True).count() == 200


@pytest.mark.parametrize("catalog", [False, True])
def test_a_failing_channel_leaves_the_others(spark, target, name, refuse, catalog):
    refuse("_channel = 2")
    where = {"table": name} if catalog else {"path": target}
    done = tg.insert(spark.range(90), channels="id % 3", order_by="id", batch_size=10, commit="channel", **where)
    assert {(r.channel, r.ok) for r in done.log.collect()} == {(0, True), (1, True), (2, False)}
    assert {r.id % 3 for r in tg.read_table(spark, **where).collect()} == {0, 1}
    assert done.metrics["rows_failed"] == 30


def test_an_epoch_that_is_replaced_forgets_its_channels(spark, target):
    options = {"path": target, "epoch": 0, "commit": "channel"}
    tg.insert(spark.range(90), channels="id % 3", **options)
    tg.insert(spark.range(50), channels="id % 2", **options)
    assert sorted(r.id for r in tg.read_table(spark, path=target).collect()) == list(range(50))
    tg.forget(spark, path=target, writer="batch")
    assert tg.read_table(spark, path=target).count() == 0


def test_keys_of_channels_that_commit_apart(spark, target):
    rows = spark.range(60).select((F.col("id") % 20).alias("k"), "id")
    done = tg.insert(rows, path=target, channels="id % 3", order_by="id", commit="channel", primary_key="k",
                     dedupe_on_key=True)
    assert sorted(r.k for r in done.rows.collect()) == list(range(20))


def test_a_restart_repeats_the_failed_channel_only(spark, tmp_path, target, refuse, monkeypatch):
    feed = str(tmp_path / "feed")
    spark.range(60).select("id", F.lit("x").alias("v")).write.parquet(feed)
    writes = []
    write = TableStore.write_epoch

    def noted(self, kind, df, writer, epoch, **more):
        write(self, kind, df, writer, epoch, **more)
        if kind == "rows":
            writes.append(writer.rpartition(".c")[2])

    monkeypatch.setattr(TableStore, "write_epoch", noted)
    refuse("_channel = 1", times=3)             # as many as there are channels

    def run():
        done = tg.insert(spark.readStream.schema(SCHEMA).parquet(feed), path=target, checkpoint=f"{target}-cp",
                         channels="id % 3", order_by="id", commit="channel", trigger="availableNow")
        done.await_termination()
        return done

    with pytest.raises(StreamingQueryException):
        run()
    assert sorted(writes) == ["0", "2"]
    assert tg.read_table(spark, path=target, committed_only=True).count() == 40
    done = run()
    assert sorted(writes) == ["0", "1", "2"]
    assert sorted(r.id for r in done.rows.collect()) == list(range(60))
    assert done.metrics["rows_ok"] == 60


def pause(df):
    """Rows that take about a millisecond each: a hash in many rounds."""
    busy = F.expr("aggregate(sequence(1, 2000), cast(id as string), (s, i) -> sha2(s, 256))")
    return df.select("id", busy.alias("v"))


def test_an_insert_over_the_drain_limit_is_cancelled(spark, target):
    started = time.monotonic()
    with pytest.raises(DrainLimitExceeded):
        tg.insert(pause(spark.range(0, 400_000, 1, 8)), path=target, drain_limit=2)
    assert time.monotonic() - started < 40
    assert tg.read_table(spark, path=target).count() == 0
    done = tg.insert(spark.range(10).select("id", F.lit("x").alias("v")), path=target, drain_limit=300)
    assert done.rows.count() == 10


@pytest.mark.parametrize("commit", ["epoch", "channel"])
def test_a_stream_over_the_drain_limit_runs_the_epoch_again(spark, tmp_path, target, commit):
    feed = str(tmp_path / "feed")
    spark.range(400_000).repartition(8).write.parquet(feed)
    stream = spark.readStream.schema("id bigint").parquet(feed)
    options = {"path": target, "checkpoint": f"{target}-cp", "trigger": "availableNow", "schema": "int64 id, optional<rstring> v",
               "commit": commit, "channels": 2}
    done = tg.insert(pause(stream), drain_limit=2, **options)
    with pytest.raises(StreamingQueryException, match="DrainLimitExceeded"):
        done.await_termination()
    assert tg.read_table(spark, path=target).count() == 0
    done = tg.insert(stream.select("id", F.lit("x").alias("v")), drain_limit=300, **options)
    done.await_termination()
    assert done.rows.distinct().count() == 400_000


def test_refused_options(spark, target):
    for options in ({"commit": "batch"}, {"drain_limit": 0}, {"commit": "channel", "track_batches": True}):
        with pytest.raises(OptionError):
            tg.insert(spark.range(3), path=target, **options)
    with pytest.raises(OptionError, match="channels"):
        tg.insert(spark.range(2000), path=target, channels="id", commit="channel")
