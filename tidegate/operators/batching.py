"""Count-based batches: channels, batch numbers and the one-row-per-batch log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbering import GROUP_ROWS, PART, SEQ, partition_offsets

CHANNEL, BATCH, BAD = "_channel", "_batch_no", "_bad"
NO_CHANNEL = -1

LOG_SCHEMA = T.StructType([
    T.StructField("channel", T.LongType()),
    T.StructField("batch_no", T.LongType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("order_lo", T.StringType()),
    T.StructField("order_hi", T.StringType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("duration_ms", T.LongType()),
])


def channel_column(channels, key_values: list[Column]) -> Column:
    """A number of channels fed by key hash, or an expression naming the channel."""
    if isinstance(channels, int):
        if channels == 1:
            return F.lit(0).cast("bigint")
        return F.pmod(F.xxhash64(*key_values), F.lit(channels)).cast("bigint")
    chosen = F.expr(channels) if isinstance(channels, str) else channels
    return F.coalesce(chosen.cast("bigint"), F.lit(NO_CHANNEL).cast("bigint"))


def order_names(order_by: list[str]) -> list[str]:
    return [f"_o{i}" for i in range(len(order_by))]


def with_batch_numbers(numbered: DataFrame, batch_size: int) -> DataFrame:
    return numbered.withColumn(BATCH, F.expr(f"{SEQ} div {batch_size}"))


def summarise_batches(numbered: DataFrame, order: list[str]) -> DataFrame:
    """One row per batch with its verdict; a bad row fails the whole batch."""
    key = _order_key(order)
    bounds = [F.min(key).alias("lo"), F.max(key).alias("hi")] if order else []
    return numbered.groupBy(CHANNEL, BATCH).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(BAD).alias("failed"),
        *bounds,
    )


def _order_key(order: list[str]) -> Column | None:
    # A struct even of one column: min and max skip NULL values, but not structs that hold one.
    return F.struct(*order) if order else None


def _as_text(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StructType) and len(kind) == 1:
        column, kind = column[kind[0].name], kind[0].dataType
    if isinstance(kind, T.StructType):
        return F.to_json(column)
    return column.cast("string")


def log_from_batches(batches: DataFrame, duration_ms: int, all_failed: bool = False) -> DataFrame:
    ok = F.lit(False) if all_failed else ~F.col("failed")
    return batches.select(
        F.col(CHANNEL).alias("channel"),
        F.col(BATCH).alias("batch_no"),
        F.col("n_rows"),
        _as_text(batches, "lo").alias("order_lo"),
        _as_text(batches, "hi").alias("order_hi"),
        ok.alias("ok"),
        F.lit(duration_ms).cast("bigint").alias("duration_ms"),
    )


def batches_from_counts(offsets: DataFrame, batch_size: int) -> DataFrame:
    """Batches of rows in arrival order, from cumulated (channel, partition) sizes alone.

    Every partition lists the batches that start in it. The partitions of a channel lie
    in one task after they were cumulated, so they are spread again before they grow
    into batches. The number of tasks is fixed: judged by its size before it grows,
    adaptive execution would put them all into one.
    """
    tasks = int(offsets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.expr(f"(offset + {batch_size - 1}) div {batch_size}")
    last = F.expr(f"(offset + cnt - 1) div {batch_size}")
    started = (offsets.where(first <= last).repartition(tasks, CHANNEL, PART)
               .select(CHANNEL, GROUP_ROWS, F.explode(F.sequence(first, last)).alias(BATCH)))
    return started.select(
        CHANNEL, BATCH,
        F.least(F.lit(batch_size).cast("bigint"),
                F.col(GROUP_ROWS) - F.col(BATCH) * batch_size).alias("n_rows"),
        F.lit(False).alias("failed"),
    )


def arrival_offsets(df: DataFrame) -> DataFrame:
    """Cumulated sizes of the (channel, partition) groups of ``df``."""
    sized = df.groupBy(CHANNEL, PART).agg(F.count(F.lit(1)).alias("cnt"))
    return partition_offsets(sized, [CHANNEL])
