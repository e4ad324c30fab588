"""Row numbers, batches and verdicts against plain Python models."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tidegate as tg
from tidegate import storage
from tidegate.operators.numbering import number_rows


def model(rows, batch_size):
    """Rows (channel, key, bad) -> {(channel, key): (batch_no, accepted)}."""
    channels = defaultdict(list)
    for channel, key, bad in rows:
        channels[channel].append((key, bad))
    out = {}
    for channel, members in channels.items():
        members.sort()
        for start in range(0, len(members), batch_size):
            batch = members[start:start + batch_size]
            ok = not any(bad for _, bad in batch)
            for key, _ in batch:
                out[channel, key] = (start // batch_size, ok)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "channel bigint, key bigint, bad boolean").repartition(5)


@pytest.mark.parametrize("evaluate_once", [False, True])
@settings(max_examples=4, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(-1000, 1000), unique=True, min_size=1, max_size=120),
       width=st.integers(1, 4), batch_size=st.integers(1, 17), every=st.integers(1, 40))
def test_batches_match_the_model(spark, evaluate_once, keys, width, batch_size, every):
    rows = [(k % width, k, i % every == every - 1) for i, k in enumerate(keys)]
    expected = model(rows, batch_size)
    done = tg.insert(frame(spark, rows), path=storage.scratch_path(spark, "t"), channels="channel",
                     order_by="key", batch_size=batch_size, reject_when="bad",
                     evaluate_once=evaluate_once, track_batches=True)
    got = {(r.channel, r.key): (r.batch_no, r._Inserted_) for r in done.assignments.collect()}
    assert got == expected
    assert {(r.channel, r.key) for r in done.rows.collect()} == {k for k, v in expected.items() if v[1]}
    flags = {(r.channel, r.key): r._Inserted_ for r in done.results.collect()}
    assert flags == {k: v[1] for k, v in expected.items()}
    log = {(r.channel, r.batch_no): (r.n_rows, r.ok) for r in done.log.collect()}
    counts = defaultdict(int)
    for (channel, _), (batch, _ok) in expected.items():
        counts[channel, batch] += 1
    assert log == {(c, b): (counts[c, b], ok) for (c, _), (b, ok) in expected.items()}
    done.release()


def test_numbers_are_exact_with_a_hot_group_and_equal_keys(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id")).alias("g"), F.lit(1).alias("k"), "id")
    numbered = number_rows(df, ["g"], ["k"], storage.scratch_path(spark, "n"))
    per_group = numbered.groupBy("g").agg(
        F.count("*").alias("n"), F.countDistinct("_seq").alias("d"), F.min("_seq").alias("lo"),
        F.max("_seq").alias("hi"), F.max("_group_rows").alias("size"))
    assert per_group.where("n <> d or lo <> 0 or hi <> n - 1 or size <> n").isEmpty()
    # The hot group is spread over several tasks although all its keys are equal.
    assert numbered.where("g = 0").select("_part").distinct().count() > 2


def test_bad_batch_in_the_middle(spark, target):
    df = spark.range(150)
    done = tg.insert(df, path=target, order_by="id", batch_size=50, reject_when="id = 77")
    flags = {r.id: r._Inserted_ for r in done.results.collect()}
    assert sum(flags.values()) == 100
    assert {i for i, ok in flags.items() if not ok} == set(range(50, 100))
    assert done.metrics == {"n_write_successes": 2, "n_write_failures": 1,
                            "rows_ok": 100, "rows_failed": 50}


def test_fail_policy_raises_and_stores_nothing(spark, target):
    options = {"path": target, "order_by": "id", "batch_size": 50, "on_failure": "fail"}
    with pytest.raises(tg.InsertFailed) as e:
        tg.insert(spark.range(150), reject_when="id = 77", **options)
    assert (e.value.batches_failed, e.value.rows_failed) == (1, 50)
    assert tg.read_table(spark, path=target).count() == 0
    assert tg.read_log(spark, path=target).count() == 0
    assert tg.insert(spark.range(150), reject_when="id < 0", **options).rows.count() == 150


def test_null_in_a_required_column_rejects_its_batch(spark, target):
    df = spark.range(100).select("id", F.when(F.col("id") != 60, F.lit("x")).alias("s"))
    done = tg.insert(df, path=target, schema="int64 id, rstring s", order_by="id", batch_size=25)
    assert done.metrics["rows_failed"] == 25
    assert done.rows.where("id between 50 and 74").count() == 0


def test_required_column_without_order(spark, tmp_path):
    clean = spark.range(100).select("id", F.when(F.col("id") >= 0, F.lit("x")).alias("s"))
    schema = "int64 id, rstring s"
    assert tg.insert(clean, path=str(tmp_path / "a"), schema=schema, batch_size=30).rows.count() == 100
    dirty = clean.withColumn("s", F.when(F.col("id") != 5, F.col("s")))
    done = tg.insert(dirty, path=str(tmp_path / "b"), schema=schema, batch_size=30)
    sizes = {r.batch_no: r.n_rows for r in done.log.collect()}
    assert sizes == {0: 30, 1: 30, 2: 30, 3: 10}
    failed = [r for r in done.log.collect() if not r.ok]
    assert len(failed) == 1 and done.rows.count() == 100 - failed[0].n_rows
    assert done.results.count() == 100


@pytest.mark.parametrize("copies", [2, 30])
def test_equal_order_keys_across_a_verdict_boundary(spark, target, copies):
    # Batches of 10 cut through groups of equal keys; one bad row fails one batch exactly.
    rows = [(k, c, False) for k in range(12) for c in range(copies)]
    rows[copies] = (*rows[copies][:2], True)
    df = spark.createDataFrame(rows, "k int, c int, bad boolean")
    done = tg.insert(df, path=target, order_by="k", batch_size=10, reject_when="bad",
                     track_batches=True)
    log = done.log.collect()
    failed = [r for r in log if not r.ok]
    assert len(failed) == 1 and failed[0].n_rows in (10, len(rows) % 10)
    assert done.rows.count() == len(rows) - failed[0].n_rows
    assert done.results.where("not _Inserted_").count() == failed[0].n_rows
    assert done.results.count() == len(rows)
    assert done.rows.where("bad").count() == 0


def test_input_that_changes_between_reads_is_read_once(spark, target):
    df = spark.range(5000).select("id", F.rand().alias("r"))
    done = tg.insert(df, path=target, order_by="r", batch_size=7, reject_when="r > 0.97")
    assert done.rows.where("r > 0.97").count() == 0
    results = done.results
    assert results.count() == 5000 and results.select("id").distinct().count() == 5000
    stored = {(r.id, r.r) for r in done.rows.collect()}
    assert stored == {(r.id, r.r) for r in results.where("_Inserted_").collect()}


def test_null_order_keys_and_channels(spark, target):
    df = spark.createDataFrame([(None, None), (1, None), (None, 5), (2, 7)], "c bigint, k bigint")
    done = tg.insert(df, path=target, channels="c", order_by="k", batch_size=1,
                     reject_when="k is null and c is null", track_batches=True)
    assert {r.channel for r in done.log.collect()} == {-1, 1, 2}
    assert done.rows.count() == 3
    assert done.results.count() == 4


def test_composite_order(spark, target):
    df = spark.range(100).select((F.col("id") % 10).alias("a"), F.col("id").alias("b"))
    done = tg.insert(df, path=target, order_by="a, b", batch_size=10, reject_when="a = 3 and b = 53",
                     track_batches=True)
    assert done.rows.count() == 90 and done.rows.where("a = 3").count() == 0
    assert {r.batch_no for r in done.assignments.where("a = 3").collect()} == {3}
    first = done.log.where("batch_no = 0").first()
    assert first.order_lo == '{"_o0":0,"_o1":0}'


def test_many_failed_keys_are_not_broadcast(spark, target, monkeypatch):
    monkeypatch.setattr("tidegate.operators.sink.BROADCAST_ROWS", 10)
    done = tg.insert(spark.range(1000), path=target, order_by="id", batch_size=50,
                     reject_when="id % 100 = 7")
    assert done.metrics["rows_failed"] == 500 and done.rows.count() == 500
    assert done.results.where("not _Inserted_").count() == 500


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_batches_of_a_hot_channel_are_listed_by_many_tasks(spark, adaptive):
    from tidegate.operators.batching import arrival_offsets, batches_from_counts
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    try:
        placed = spark.range(10_000, numPartitions=16).selectExpr(
            "0L _channel", "spark_partition_id() _part")
        batches = batches_from_counts(arrival_offsets(placed), 7)
        assert batches.count() == -(-10_000 // 7)
        assert batches.agg(F.sum("n_rows")).first()[0] == 10_000
        assert batches.select(F.spark_partition_id()).distinct().count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")


@pytest.mark.parametrize("n, batch_size, sizes", [
    (105, 50, [50, 50, 5]), (100, 50, [50, 50]), (1, 50, [1]), (0, 50, []), (7, 1, [1] * 7)])
@pytest.mark.parametrize("order_by", [None, "id"])
def test_batch_sizes(spark, target, n, batch_size, sizes, order_by):
    done = tg.insert(spark.range(n), path=target, batch_size=batch_size, order_by=order_by)
    log = sorted((r.batch_no, r.n_rows) for r in done.log.collect())
    assert log == list(enumerate(sizes))
    assert done.rows.count() == n and done.results.where("_Inserted_").count() == n


@pytest.mark.parametrize("order_by", [None, "id"])
def test_channels_by_key_hash(spark, target, order_by):
    done = tg.insert(spark.range(1000), path=target, batch_size=50, channels=3, order_by=order_by)
    per_channel = {r.channel: (r.n, r.b) for r in done.log.groupBy("channel").agg(
        F.sum("n_rows").alias("n"), F.count("*").alias("b")).collect()}
    assert set(per_channel) == {0, 1, 2}
    assert sum(n for n, _ in per_channel.values()) == 1000
    assert all(b == -(-n // 50) for n, b in per_channel.values())


def test_results_can_be_left_out(spark, target):
    done = tg.insert(spark.range(10), path=target, order_by="id", reject_when="id = 3",
                     batch_size=5, results=False)
    assert done.rows.count() == 5
    with pytest.raises(tg.IngestError, match="no results"):
        done.results
    assert not storage.exists(spark, f"{target}/results")


def test_stored_results_when_the_table_cannot_show_them(spark, target):
    df = spark.sql("select explode(sequence(200, 259)) v")
    done = tg.insert(df, path=target, schema="uint8 v", order_by="v", batch_size=20,
                     reject_when="v = 205")
    flags = {r.v: r._Inserted_ for r in done.results.collect()}
    assert flags == {v: v >= 220 for v in range(200, 260)}
    assert done.rows.count() == 40


def test_storage_failure_under_report_flags_every_row(spark, target, monkeypatch):
    from tidegate.sources.tables import TableStore
    write = TableStore.write_epoch

    def broken(self, kind, df, writer, epoch):
        if kind == "rows":
            raise OSError("disk gone")
        return write(self, kind, df, writer, epoch)

    monkeypatch.setattr(TableStore, "write_epoch", broken)
    for extra in ({}, {"order_by": "id"}, {"order_by": "id", "reject_when": "id = 3"}):
        done = tg.insert(spark.range(30), path=target, batch_size=10, epoch=0, **extra)
        assert isinstance(done.outcome.error, OSError)
        assert done.results.where("_Inserted_").count() == 0 and done.results.count() == 30
        assert done.metrics == {"n_write_successes": 0, "n_write_failures": 3,
                                "rows_ok": 0, "rows_failed": 30}
        assert tg.read_table(spark, path=target).count() == 0
    with pytest.raises(OSError):
        tg.insert(spark.range(30), path=target, on_failure="fail")


def test_dedupe_keeps_the_first_copy_and_skips_stored_keys(spark, target):
    options = {"path": target, "primary_key": "k", "dedupe_on_key": True, "order_by": "o"}
    first = spark.sql("select * from values (1, 30), (1, 10), (1, 20), (2, 5), (null, 1), (null, 2) t(k, o)")
    done = tg.insert(first, **options)
    assert sorted(map(tuple, done.rows.collect()), key=str) == [(1, 10), (2, 5), (None, 1)]
    again = spark.sql("select * from values (2, 1), (3, 9), (null, 0) t(k, o)")
    assert sorted(map(tuple, tg.insert(again, **options).rows.collect())) == [(3, 9)]
    # The same epoch again: its own rows do not count as stored.
    tg.insert(first, epoch=0, **options)
    assert tg.read_table(spark, path=target).count() == 4
    # Every row was taken care of.
    assert done.results.where("_Inserted_").count() == 6


def test_dedupe_into_a_catalog_table_without_order(spark, name):
    df = spark.range(40).select((F.col("id") % 8).alias("k"))
    for _ in range(2):
        tg.insert(df, name, primary_key="k", dedupe_on_key=True)
    assert sorted(r.k for r in spark.table(name).collect()) == list(range(8))


def test_scratch_is_cleaned(spark, target):
    before = set(storage.children(spark, storage._scratch_root(spark)))
    done = tg.insert(spark.range(50), path=target, order_by="id", batch_size=7, reject_when="id = 3",
                     track_batches=True)
    kept = set(storage.children(spark, storage._scratch_root(spark))) - before
    assert len(kept) == 1 and done.assignments.count() == 50
    done.release()
    tg.insert(spark.range(50), path=target, order_by="id", batch_size=7, reject_when="id = 3")
    assert set(storage.children(spark, storage._scratch_root(spark))) == before
    with pytest.raises(tg.IngestError, match="track_batches"):
        tg.insert(spark.range(5), path=target).assignments


@pytest.mark.parametrize("bad_id", [10, 120])
def test_null_order_keys_longer_than_a_batch(spark, target, bad_id):
    """Half of the rows have no order key; exactly one batch of 50 fails."""
    rows = spark.range(150).select("id", F.when(F.col("id") >= 75, F.col("id")).alias("o"))
    done = tg.insert(rows, path=target, batch_size=50, order_by="o", reject_when=f"id = {bad_id}")
    failed = sum(r["n_rows"] for r in done.log.where("not ok").collect())
    assert failed == 50
    assert done.rows.count() == 100
    assert done.results.where("not _Inserted_").count() == 50
