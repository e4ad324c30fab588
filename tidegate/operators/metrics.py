"""Counters and insert times from the write log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import storage
from .numbering import GROUP_ROWS, PART, SEQ, number_rows

# Fixed value: samples a moving average spans while it is being taken.
AVERAGE_SPAN = 10_001


def write_counters(log: DataFrame) -> DataFrame:
    """Written and failed batches, and their rows, per channel."""
    ok, rows = F.col("ok"), F.col("n_rows")
    return log.groupBy("channel").agg(
        F.count(F.when(ok, 1)).alias("n_write_successes"),
        F.count(F.when(~ok, 1)).alias("n_write_failures"),
        F.coalesce(F.sum(F.when(ok, rows)), F.lit(0)).alias("rows_ok"),
        F.coalesce(F.sum(F.when(~ok, rows)), F.lit(0)).alias("rows_failed"),
    )


def _numbered_samples(durations: DataFrame, channel: str, seq: str, duration: str) -> DataFrame:
    """Non-zero durations with their place (0-based) among those of the channel.

    ``_counted`` is the part a sample adds to the average: the first one adds nothing.
    """
    spark = durations.sparkSession
    samples = durations.where(F.col(duration) != 0).select(
        F.col(channel).alias("channel"), F.col(seq).alias("seq"),
        F.col(duration).cast("bigint").alias("duration"))
    numbered = number_rows(samples, ["channel"], ["seq"], storage.scratch_path(spark, "times"))
    return numbered.withColumn(
        "_counted", F.when(F.col(SEQ) > 0, F.col("duration")).otherwise(F.lit(0)))


def insert_times_running(durations: DataFrame, channel: str = "channel", seq: str = "seq",
                         duration: str = "duration_ms") -> DataFrame:
    """Minimum, maximum and moving average after every sample of every channel.

    Totals up to a sample are those of its partition plus those of earlier partitions,
    so no task sees a whole channel. The average is the difference of two such totals;
    the older one is fetched with a lag inside blocks of the span's length, each of
    which also receives the rows of the block before.
    """
    samples = _numbered_samples(durations, channel, seq, duration)
    parts = samples.groupBy("channel", PART).agg(
        F.sum("_counted").alias("part_sum"), F.min("duration").alias("part_min"),
        F.max("duration").alias("part_max"))
    earlier = (Window.partitionBy("channel").orderBy(PART)
               .rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        "channel", PART,
        F.coalesce(F.sum("part_sum").over(earlier), F.lit(0)).alias("sum_before"),
        F.min("part_min").over(earlier).alias("min_before"),
        F.max("part_max").over(earlier).alias("max_before"))
    inside = (Window.partitionBy("channel", PART).orderBy(SEQ)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = samples.join(parts, ["channel", PART]).select(
        "channel", "seq", "duration", SEQ,
        (F.sum("_counted").over(inside) + F.col("sum_before")).alias("total"),
        F.least(F.min("duration").over(inside), F.col("min_before")).alias("t_min"),
        F.greatest(F.max("duration").over(inside), F.col("max_before")).alias("t_max"))

    block = F.expr(f"{SEQ} div {AVERAGE_SPAN}")
    blocked = running.select("*", F.posexplode(F.array(block, block + 1)).alias("_older", "_block"))
    in_block = Window.partitionBy("channel", "_block").orderBy(SEQ)
    spanned = blocked.withColumn(
        "_left", F.coalesce(F.lag("total", AVERAGE_SPAN).over(in_block), F.lit(0)))
    n_averaged = F.least(F.col(SEQ), F.lit(AVERAGE_SPAN))
    average = F.when(F.col(SEQ) == 0, F.col("duration")).otherwise(
        F.expr("(total - _left) div _averaged"))
    return spanned.where("_older = 0").withColumn("_averaged", n_averaged).select(
        "channel", "seq", "t_min", "t_max", average.alias("t_avg"))


def insert_times_final(durations: DataFrame, channel: str = "channel", seq: str = "seq",
                       duration: str = "duration_ms") -> DataFrame:
    """Minimum, maximum and moving average after the last sample of every channel."""
    samples = _numbered_samples(durations, channel, seq, duration)
    averaged = (F.col(SEQ) > 0) & (F.col(SEQ) >= F.col(GROUP_ROWS) - AVERAGE_SPAN)
    totals = samples.groupBy("channel").agg(
        F.min("duration").alias("t_min"), F.max("duration").alias("t_max"),
        F.sum(F.when(averaged, F.col("duration"))).alias("total"),
        F.count(F.when(averaged, 1)).alias("n"))
    return totals.select(
        "channel", "t_min", "t_max",
        F.when(F.col("n") == 0, F.col("t_max")).otherwise(F.expr("total div n")).alias("t_avg"))
