"""Shapes of the physical plans: what is read, moved and broadcast."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import tidegate as tg
from tidegate.operators import sink
from tidegate.operators.metrics import insert_times_running, write_counters
from tidegate.options import resolve
from tidegate.sources.tables import TableStore


def explained(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def events(spark, small):
    return spark.read.parquet(f"{small}/events.parquet")


def planned(df, path, **options):
    resolved = resolve(df.sparkSession, path=path, **options)
    store = TableStore(df.sparkSession, path=path)
    return sink.plan_insert(df, resolved, store), store


def test_rows_are_written_without_a_shuffle(events, target):
    plan, store = planned(events, target, order_by="event_id", channels="user_id % 3")
    rows = sink.with_helpers(events, plan)
    text = explained(sink.table_rows(rows, plan, store, sink.Epoch("batch", 0)))
    assert "Exchange" not in text and "Window" not in text and "Python" not in text
    assert "WholeStageCodegen" in text or "[codegen id" in text


def test_sharded_rows_are_rebalanced_once(events, target):
    plan, store = planned(events, target, partitioning_key="user_id", shards=4)
    rows = sink.with_helpers(events, plan)
    text = explained(sink.table_rows(rows, plan, store, sink.Epoch("batch", 0)))
    assert text.count("REBALANCE_PARTITIONS_BY_COL") >= 1 and "Window" not in text


def test_verdict_reads_and_moves_the_tested_columns_only(events, target, spark):
    plan, _ = planned(events, target, order_by="event_id", channels="user_id % 3",
                      reject_when="value > 250", batch_size=50)
    narrow = sink.with_helpers(events, plan).select("_channel", "_bad", "_o0")
    text = explained(narrow.repartitionByRange("_channel", "_o0"))
    scan = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert scan == ["ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>"]


def test_bad_rows_are_looked_for_in_file_statistics(events, target):
    plan, _ = planned(events, target, schema=(
        "int64 event_id, optional<timestamp_ntz> ts, int64 user_id, optional<rstring> event_type, "
        "optional<float64> value, optional<rstring> props"))
    text = explained(events.where(plan.bad).select("event_id"))
    assert "PushedFilters: [Or(IsNull(event_id),IsNull(user_id))]" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text


def test_accepted_rows_join_by_equality(events, target, spark):
    plan, _ = planned(events, target, order_by="event_id", channels="user_id % 3",
                      reject_when="value > 250", batch_size=50)
    verdict = sink._judge(sink.with_helpers(events, plan), plan, False, f"{target}-scratch")
    text = explained(verdict.accepted())
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BroadcastHashJoin LeftAnti" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = explained(verdict.accepted())
        assert "SortMergeJoin LeftAnti" in text and "Broadcast" not in text
        assert verdict.accepted().count() + verdict.rejected().count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_which_inputs_repeat(spark, events, target, name):
    def repeats(df, **options):
        resolved = resolve(spark, dry_run=True, **options)
        return sink.repeats_exactly(df, sink.plan_insert(df, resolved, None))

    events.createOrReplaceTempView("repeating_events")
    tg.insert(spark.range(3), path=target)
    tg.insert(spark.range(3), name)                  # rows of a catalog table are partitioned
    events.limit(0).write.saveAsTable(f"{name}_plain")
    assert repeats(spark.table(f"{name}_plain")) and not repeats(spark.table(name))
    for df in (events, events.where("value > 3").select("event_id", "value"), spark.range(5),
               spark.table("repeating_events"), events.union(events),
               tg.read_table(spark, path=target),
               events.select("event_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("x"))):
        assert repeats(df)
    for df in (events.withColumn("r", F.rand()), events.limit(5), events.dropDuplicates(["user_id"]),
               events.groupBy("user_id").agg(F.first("value").alias("v")),
               events.join(events.select("event_id"), "event_id"), events.orderBy("ts").limit(3),
               events.repartition(3), events.sample(0.5)):
        assert not repeats(df)
    assert not repeats(events, channels="cast(rand() * 3 as int)")
    assert not repeats(events, order_by=["rand()"])
    assert not repeats(events, reject_when="rand() > 0.5")


def test_failed_keys_above_the_bound_are_shuffled(events, target, monkeypatch):
    monkeypatch.setattr(sink, "BROADCAST_ROWS", 10)
    plan, _ = planned(events, target, order_by="event_id", reject_when="value > 250", batch_size=50)
    verdict = sink._judge(sink.with_helpers(events, plan), plan, False, f"{target}-scratch")
    assert verdict.rows_failed > 10
    for side in (verdict.accepted(), verdict.rejected()):
        text = explained(side)
        assert "SortMergeJoin" in text and "Broadcast" not in text


def test_reading_one_insert_lists_its_folder_only(spark, target):
    for _ in range(3):
        done = tg.insert(spark.range(10), path=target, writer="one")
    assert {f.rsplit("/", 2)[-2] for f in done.rows.inputFiles()} == {"_epoch=2"}


def test_reading_the_table_prunes_columns(spark, events, target):
    tg.insert(events, path=target)
    text = explained(tg.read_table(spark, path=target).where("user_id = 5").select("event_id"))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text
    assert "EqualTo(user_id,5)" in text


def test_counters_combine_before_the_shuffle(spark, target):
    log = tg.insert(spark.range(10), path=target).log
    text = explained(write_counters(log))
    assert "partial_count" in text


def test_running_times_never_window_a_whole_channel(spark):
    df = spark.range(100).selectExpr("0L channel", "id seq", "id + 1 duration_ms")
    text = explained(insert_times_running(df))
    windows = [line for line in text.splitlines() if "windowspecdefinition" in line]
    assert windows and not any("SinglePartition" in line for line in text.splitlines())
    # Whole channels are cumulated over partition totals only; samples by partition or block.
    for line in windows:
        if "windowspecdefinition(channel" in line and "_seq" in line:
            spec = line.split("windowspecdefinition(")[1]
            assert "_part" in spec or "_block" in spec
