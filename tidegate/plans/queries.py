"""The registered queries and the SQL that specifies their results.

Every query runs the engine over whole tables: it inserts, then reads back what was
stored, returned or logged.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from .. import api, storage
from ..operators.keys import audit_keys
from ..operators.metrics import insert_times_final, insert_times_running, write_counters
from ..operators.sink import insert_batch
from ..options import resolve
from ..sources.counters import counter_over, labelled, sample_stream, sample_stream_optional
from ..sources.tables import INSERTED, SHARD, TableStore
from ..streaming.stream import EpochWriter

CHANNELS = "user_id % 3"
BATCH_SIZE = 50
REJECT = "value > 250"
REFUSED = "event_id % 4999 = 0"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir))


def _target(spark: SparkSession) -> str:
    return storage.scratch_path(spark, "table")


def _insert(df: DataFrame, **options):
    return api.insert(df, path=_target(df.sparkSession), **options)


def _insert_events(spark: SparkSession, sf_dir: str, **options):
    defaults = {"channels": CHANNELS, "order_by": "event_id", "batch_size": BATCH_SIZE}
    return _insert(_events(spark, sf_dir), **{**defaults, **options})


# -- inserts ---------------------------------------------------------------------


def insert_readback(spark, sf_dir):
    done = _insert_events(spark, sf_dir)
    return done.rows.withColumn(INSERTED, F.lit(True))


def result_projection(spark, sf_dir):
    return _insert_events(spark, sf_dir).results.select("event_id", "event_type", INSERTED)


def batch_atomic_reject(spark, sf_dir):
    done = _insert_events(spark, sf_dir, reject_when=REJECT, track_batches=True)
    return done.assignments


class _Refusing(TableStore):
    """A store whose writing tasks fail on some rows, in the first so many writes."""

    def __init__(self, spark: SparkSession, path: str, predicate: str, writes: int = 10**9):
        super().__init__(spark, path=path)
        self._predicate, self._left = predicate, writes

    def write_epoch(self, kind, df, writer, epoch, mode="overwrite"):
        if kind == "rows" and self._left > 0:
            self._left -= 1
            first = df.columns[0]
            refused = F.raise_error(F.lit("refused by the store")).cast(df.schema[first].dataType)
            df = df.withColumn(first, F.when(F.expr(self._predicate), refused).otherwise(F.col(first)))
        super().write_epoch(kind, df, writer, epoch, mode)


def storage_reject(spark, sf_dir):
    """Some rows can't be stored: their batches fail, each alone, and the others are there."""
    events, path = _events(spark, sf_dir), _target(spark)
    options = resolve(spark, path=path, channels=CHANNELS, order_by="event_id", batch_size=BATCH_SIZE)
    done = insert_batch(events, options, store=_Refusing(spark, path, REFUSED))
    stored = done.rows.select("event_id", F.lit(True).alias("stored"))
    return done.results.select("event_id", INSERTED).join(stored, "event_id", "left").select(
        "event_id", INSERTED, F.coalesce("stored", F.lit(False)).alias("stored"))


def channel_restart(spark, sf_dir):
    """Channels commit apart: the store refuses one of them, and the restart adds that one."""
    path = _target(spark)
    checkpoint = f"{path}-checkpoint"
    options = {"path": path, "channels": CHANNELS, "order_by": "event_id", "batch_size": BATCH_SIZE,
               "checkpoint": checkpoint, "commit": "channel"}
    stream = _event_stream(spark, sf_dir)
    writer = EpochWriter(stream, resolve(spark, **options), store=_Refusing(spark, path, "_channel = 1"))
    failing = (stream.writeStream.foreachBatch(lambda batch, epoch: writer(batch, epoch) and None)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    with contextlib.suppress(StreamingQueryException):
        failing.awaitTermination()
    before = api.read_table(spark, path=path, committed_only=True).select("event_id", F.lit(True).alias("first_run"))
    before.write.parquet(f"{path}-before")
    done = api.insert(_event_stream(spark, sf_dir), trigger="availableNow", **options)
    done.await_termination()
    return done.rows.join(spark.read.parquet(f"{path}-before"), "event_id", "left").select(
        "event_id", F.coalesce("first_run", F.lit(False)).alias("first_run"))


def result_ok_filter(spark, sf_dir):
    done = _insert_events(spark, sf_dir, reject_when=REJECT)
    return done.results.where(INSERTED).select("event_id", F.lit("ok").alias("result"))


def accepted_rows(spark, sf_dir):
    return _insert_events(spark, sf_dir, reject_when=REJECT).rows


def dry_run(spark, sf_dir):
    events = _events(spark, sf_dir)
    path = _target(spark)
    done = api.insert(events, path=path, dry_run=True)
    written = 0 if not storage.exists(spark, path) else api.read_table(spark, path=path).count()
    return spark.range(1).select(
        F.lit(done.metrics["rows_converted"]).cast("bigint").alias("rows_converted"),
        F.lit(written).cast("bigint").alias("rows_written"))


def partition_key_layout(spark, sf_dir):
    done = _insert_events(spark, sf_dir, partitioning_key="user_id", shards=8)
    placed = done.store.stored_rows().groupBy("user_id", SHARD).agg(F.count(F.lit(1)).alias("n"))
    return placed.groupBy("user_id").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_partitions"))


def primary_key_audit(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    done = _insert(_table(spark, sf_dir, "lineitem"), primary_key=keys)
    return audit_keys(done.rows, keys)


# -- conversions -----------------------------------------------------------------


def type_conform(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("n8"), F.col("l_linenumber").alias("n16"),
        F.col("l_quantity").alias("n32"), F.col("l_partkey").alias("n64"),
        F.col("l_extendedprice").alias("f64"), F.col("l_returnflag").alias("s"),
        F.col("l_shipdate").alias("ts"))
    return _insert(lines, schema=(
        "int64 l_orderkey, int8 n8, int16 n16, int32 n32, int64 n64, float64 f64, rstring s, "
        "timestamp ts"), batch_size=BATCH_SIZE).rows


def unsigned_wrap(spark, sf_dir):
    ids = F.col("event_id")
    numbers = _events(spark, sf_dir).select(
        "event_id", ids.alias("u8"), (ids * 7).alias("u16"), (ids * 1000003).alias("u32"),
        F.expr("cast(18446744073709551615 - event_id as decimal(20,0))").alias("u64"))
    return _insert(numbers, schema="int64 event_id, uint8 u8, uint16 u16, uint32 u32, uint64 u64").rows


def _optional_events(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("opt_i64"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("opt_str"))


def optional_null(spark, sf_dir):
    return _insert(_optional_events(spark, sf_dir), order_by="event_id",
                   schema="int64 event_id, optional<int64> opt_i64, optional<rstring> opt_str").rows


def optional_zero(spark, sf_dir):
    return _insert(_optional_events(spark, sf_dir), order_by="event_id", optional_mode="zero",
                   schema="int64 event_id, optional<int64> opt_i64, optional<rstring> opt_str").rows


def timestamp_millis(spark, sf_dir):
    times = _events(spark, sf_dir).select("event_id", F.col("ts").alias("ts_ms"))
    return _insert(times, timestamp_precision="ms", order_by="event_id",
                   schema="int64 event_id, timestamp_ntz ts_ms").rows


def list_column(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    stored = _insert(vectors, schema="int64 vec_id, list<float32> embedding").rows
    return stored.select("vec_id", F.size("embedding").cast("bigint").alias("n"),
                         F.col("embedding")[0].alias("first_el"))


def set_column(spark, sf_dir):
    types = _events(spark, sf_dir).groupBy("user_id").agg(
        F.collect_set("event_type").alias("types"))
    stored = _insert(types, schema="int64 user_id, set<rstring> types").rows
    return stored.select("user_id", F.array_join("types", ",").alias("types"))


def map_column(spark, sf_dir):
    props = _events(spark, sf_dir).select(
        "event_id", F.from_json("props", "map<string,bigint>").alias("props"))
    stored = _insert(props, schema="int64 event_id, map<rstring,int64> props").rows
    return stored.select("event_id", F.col("props")["k"].alias("k"))


# -- batches ---------------------------------------------------------------------


def batch_assign(spark, sf_dir):
    return _insert_events(spark, sf_dir).log.select(
        "channel", "batch_no", F.col("n_rows").alias("n"),
        F.col("order_lo").cast("bigint").alias("lo"), F.col("order_hi").cast("bigint").alias("hi"))


def auto_batch_size(spark, sf_dir):
    return _insert_events(spark, sf_dir, batch_size=None).log.select(
        "channel", "batch_no", F.col("n_rows").alias("n"))


def parallel_channels(spark, sf_dir):
    return _insert_events(spark, sf_dir).log.groupBy("channel").agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_batches"))


def write_counters_query(spark, sf_dir):
    return write_counters(_insert_events(spark, sf_dir, reject_when=REJECT).log)


def arrival_batches(spark, sf_dir):
    """Batches without an order: only their sizes are defined."""
    return _insert_events(spark, sf_dir, order_by=None).log.select(
        "channel", "batch_no", F.col("n_rows").alias("n"))


# -- insert times ----------------------------------------------------------------


def _durations(spark, sf_dir):
    return _events(spark, sf_dir).select(
        (F.col("user_id") % 3).alias("channel"), F.col("event_id").alias("seq"),
        F.floor("value").cast("bigint").alias("duration_ms"))


def insert_time_running(spark, sf_dir):
    return insert_times_running(_durations(spark, sf_dir)).select(
        "channel", F.col("seq").alias("event_id"), "t_avg", "t_min", "t_max")


def insert_time_final(spark, sf_dir):
    return insert_times_final(_durations(spark, sf_dir))


# -- streaming and replay --------------------------------------------------------


def stream_insert(spark, sf_dir):
    path = _target(spark)
    done = api.insert(_event_stream(spark, sf_dir), path=path, channels=CHANNELS,
                      order_by="event_id", batch_size=BATCH_SIZE,
                      checkpoint=f"{path}-checkpoint", trigger="availableNow")
    done.await_termination()
    return done.results


def final_flush(spark, sf_dir):
    """A stream that ends inside a batch: the last, partial batch is written too."""
    path = _target(spark)
    done = api.insert(_event_stream(spark, sf_dir), path=path, order_by="event_id", batch_size=48,
                      checkpoint=f"{path}-checkpoint", trigger="availableNow")
    done.await_termination()
    return done.log.select("batch_no", F.col("n_rows").alias("n"))


def checkpoint_restart(spark, sf_dir):
    """The stream fails after an epoch is written and before it is committed."""
    path = _target(spark)
    checkpoint = f"{path}-checkpoint"
    options = {"path": path, "channels": CHANNELS, "order_by": "event_id",
               "batch_size": BATCH_SIZE, "checkpoint": checkpoint}
    stream = _event_stream(spark, sf_dir)
    writer = api.epoch_writer(stream, **options)

    def write_then_fail(batch, epoch):
        writer(batch, epoch)
        raise RuntimeError("failure between write and commit")

    failing = (stream.writeStream.foreachBatch(write_then_fail)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    with contextlib.suppress(StreamingQueryException):
        failing.awaitTermination()
    done = api.insert(_event_stream(spark, sf_dir), trigger="availableNow", **options)
    done.await_termination()
    return done.results


def _delivered_twice(spark, sf_dir, **options):
    path = _target(spark)
    for _ in range(2):
        api.insert(_events(spark, sf_dir), path=path, channels=CHANNELS, order_by="event_id",
                   batch_size=BATCH_SIZE, **options)
    return (api.read_table(spark, path=path).groupBy("event_id")
            .agg(F.count(F.lit(1)).alias("copies")))


def replay_raw(spark, sf_dir):
    """Upstream delivers everything again as a new epoch: at least once."""
    return _delivered_twice(spark, sf_dir)


def replay_keyed(spark, sf_dir):
    """The same with de-duplication on the primary key."""
    return _delivered_twice(spark, sf_dir, primary_key="event_id", dedupe_on_key=True)


def replay_same_epoch(spark, sf_dir):
    """The same epoch runs again: its rows are replaced."""
    return _delivered_twice(spark, sf_dir, epoch=0)


# -- sources ---------------------------------------------------------------------


def counter_source(spark, sf_dir):
    ticks = counter_over(_events(spark, sf_dir), ["event_id"])
    return _insert(sample_stream(ticks), schema="int32 id, int64 id2, rstring name",
                   partitioning_key="id", primary_key="id", batch_size=BATCH_SIZE).rows


def counter_source_optional(spark, sf_dir):
    ticks = counter_over(_events(spark, sf_dir), ["event_id"])
    return _insert(
        sample_stream_optional(ticks), partitioning_key="ID", primary_key="ID",
        batch_size=BATCH_SIZE,
        schema="int32 ID, optional<int64> ID2, rstring NAME, optional<rstring> LNAME, "
               "optional<int32> OPT").rows


def list_source(spark, sf_dir):
    done = _insert(labelled(_events(spark, sf_dir), "event_id"), schema="int32 id, rstring name",
                   partitioning_key="id", primary_key="id", channels=2, order_by="id")
    return done.results.select("id", "name")


QUERIES = {
    "insert_readback": insert_readback,
    "result_projection": result_projection,
    "batch_atomic_reject": batch_atomic_reject,
    "result_ok_filter": result_ok_filter,
    "accepted_rows": accepted_rows,
    "dry_run": dry_run,
    "partition_key_layout": partition_key_layout,
    "primary_key_audit": primary_key_audit,
    "type_conform": type_conform,
    "unsigned_wrap": unsigned_wrap,
    "optional_null": optional_null,
    "optional_zero": optional_zero,
    "timestamp_millis": timestamp_millis,
    "list_column": list_column,
    "set_column": set_column,
    "map_column": map_column,
    "batch_assign": batch_assign,
    "auto_batch_size": auto_batch_size,
    "parallel_channels": parallel_channels,
    "write_counters": write_counters_query,
    "arrival_batches": arrival_batches,
    "insert_time_running": insert_time_running,
    "insert_time_final": insert_time_final,
    "stream_insert": stream_insert,
    "final_flush": final_flush,
    "checkpoint_restart": checkpoint_restart,
    "replay_raw": replay_raw,
    "replay_keyed": replay_keyed,
    "replay_same_epoch": replay_same_epoch,
    "storage_reject": storage_reject,
    "channel_restart": channel_restart,
    "counter_source": counter_source,
    "counter_source_optional": counter_source_optional,
    "list_source": list_source,
}


# -- expected results ------------------------------------------------------------


def _batched(batch_size: int, channel: str = CHANNELS) -> str:
    return (f"select *, {channel} as channel, cast(floor((row_number() over "
            f"(partition by {channel} order by event_id) - 1) / {batch_size}) as bigint) as batch_no "
            "from events")


_JUDGED = (f"select *, max(case when {REJECT} then 1 else 0 end) over "
           f"(partition by channel, batch_no) as bad from ({_batched(BATCH_SIZE)}) b")
_SIZES = ("select channel, batch_no, count(*) as n from ({}) b group by channel, batch_no")
_READBACK = ("select event_id, ts, user_id, event_type, value, props, true as _Inserted_ "
             "from events")
_SAMPLES = ("select event_id, user_id % 3 as channel, cast(floor(value) as bigint) as d from events "
            "where cast(floor(value) as bigint) <> 0")
_OPTIONAL = ("case when user_id % 3 = 0 then null else user_id end",
             "case when event_type = 'error' then null else event_type end")
_TICKS = "select row_number() over (order by event_id) - 1 as n from events"

ORACLES = {
    "insert_readback": _READBACK,
    "stream_insert": _READBACK,
    "checkpoint_restart": _READBACK,
    "result_projection": "select event_id, event_type, true as _Inserted_ from events",
    "batch_atomic_reject":
        f"select event_id, channel, batch_no, bad = 0 as _Inserted_ from ({_JUDGED}) v",
    "result_ok_filter": f"select event_id, 'ok' as result from ({_JUDGED}) v where bad = 0",
    "accepted_rows":
        f"select event_id, ts, user_id, event_type, value, props from ({_JUDGED}) v where bad = 0",
    "dry_run": "select count(*) as rows_converted, cast(0 as bigint) as rows_written from events",
    "partition_key_layout":
        "select user_id, count(*) as n_rows, cast(1 as bigint) as n_partitions from events "
        "group by user_id",
    "primary_key_audit":
        "select l_orderkey, l_linenumber, count(*) as copies from lineitem "
        "group by l_orderkey, l_linenumber having count(*) > 1",
    "type_conform":
        "select l_orderkey, cast(l_linenumber as tinyint) as n8, cast(l_linenumber as smallint) as n16, "
        "cast(l_quantity as int) as n32, l_partkey as n64, l_extendedprice as f64, "
        "l_returnflag as s, l_shipdate as ts from lineitem",
    "unsigned_wrap":
        "select event_id, cast((event_id + 128) % 256 - 128 as tinyint) as u8, "
        "cast((event_id * 7 + 32768) % 65536 - 32768 as smallint) as u16, "
        "cast((event_id * 1000003 + 2147483648) % 4294967296 - 2147483648 as int) as u32, "
        "-1 - event_id as u64 from events",
    "optional_null":
        f"select event_id, {_OPTIONAL[0]} as opt_i64, {_OPTIONAL[1]} as opt_str from events",
    "optional_zero":
        f"select event_id, coalesce({_OPTIONAL[0]}, 0) as opt_i64, {_OPTIONAL[1]} as opt_str from events",
    "timestamp_millis":
        "select event_id, cast(date_trunc('millisecond', ts) as timestamp) as ts_ms from events",
    "list_column":
        "select vec_id, cast(len(embedding) as bigint) as n, embedding[1] as first_el from embeddings",
    "set_column":
        "select user_id, array_to_string(list_sort(list_distinct(list(event_type))), ',') as types "
        "from events group by user_id",
    "map_column":
        "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "batch_assign":
        "select channel, batch_no, count(*) as n, min(event_id) as lo, max(event_id) as hi "
        f"from ({_batched(BATCH_SIZE)}) b group by channel, batch_no",
    "auto_batch_size": _SIZES.format(_batched(170)),
    "arrival_batches": _SIZES.format(_batched(BATCH_SIZE)),
    "parallel_channels":
        "select channel, count(*) as n_rows, count(distinct batch_no) as n_batches "
        f"from ({_batched(BATCH_SIZE)}) b group by channel",
    "write_counters":
        "select channel, cast(sum(1 - bad) as bigint) as n_write_successes, "
        "cast(sum(bad) as bigint) as n_write_failures, "
        "cast(sum(case when bad = 0 then n else 0 end) as bigint) as rows_ok, "
        "cast(sum(case when bad = 1 then n else 0 end) as bigint) as rows_failed from "
        f"(select channel, batch_no, count(*) as n, max(case when {REJECT} then 1 else 0 end) as bad "
        f"from ({_batched(BATCH_SIZE)}) b group by channel, batch_no) v group by channel",
    "insert_time_running":
        f"with s as ({_SAMPLES}), "
        "n as (select *, row_number() over (partition by channel order by event_id) as rn from s), "
        "a as (select *, sum(case when rn > 1 then d end) over w as sm, "
        "count(case when rn > 1 then 1 end) over w as c from n "
        "window w as (partition by channel order by event_id "
        "rows between 10000 preceding and current row)) "
        "select channel, event_id, "
        "case when rn = 1 then d else cast(floor(sm / c) as bigint) end as t_avg, "
        "min(d) over (partition by channel order by event_id "
        "rows between unbounded preceding and current row) as t_min, "
        "max(d) over (partition by channel order by event_id "
        "rows between unbounded preceding and current row) as t_max from a",
    "insert_time_final":
        f"with s as ({_SAMPLES}), "
        "n as (select *, row_number() over (partition by channel order by event_id) as rn, "
        "count(*) over (partition by channel) as c from s) "
        "select channel, min(d) as t_min, max(d) as t_max, "
        "cast(case when max(c) = 1 then max(d) else "
        "floor(sum(case when rn > 1 and rn > c - 10001 then d end) "
        "/ count(case when rn > 1 and rn > c - 10001 then 1 end)) end as bigint) as t_avg "
        "from n group by channel",
    "final_flush":
        "select batch_no, count(*) as n from (select cast(floor((row_number() over (order by event_id) - 1) "
        "/ 48) as bigint) as batch_no from events) b group by batch_no",
    "replay_raw":
        "select event_id, count(*) as copies from "
        "(select event_id from events union all select event_id from events) x group by event_id",
    "replay_keyed":
        "select event_id, cast(1 as bigint) as copies from "
        "(select event_id from events union select event_id from events) x",
    "replay_same_epoch": "select event_id, count(*) as copies from events group by event_id",
    "storage_reject":
        f"select event_id, bad = 0 as _Inserted_, bad = 0 as stored from (select *, max(case when {REFUSED} then 1 else 0 end) "
        f"over (partition by channel, batch_no) as bad from ({_batched(BATCH_SIZE)}) b) v",
    "channel_restart": f"select event_id, {CHANNELS} <> 1 as first_run from events",
    "counter_source":
        f"select cast(n as int) as id, n as id2, 'SAMPLE' as name from ({_TICKS}) t",
    "counter_source_optional":
        "select cast(n as int) as ID, n * 2 as ID2, 'SAMPLE' as NAME, cast(null as varchar) as LNAME, "
        f"cast(null as int) as OPT from ({_TICKS}) t",
    "list_source":
        "select cast(event_id as int) as id, concat('X', event_id * 2) as name from events",
}
