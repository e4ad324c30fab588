"""Counter sources: rows whose columns follow from an iteration counter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.numbering import SEQ, number_rows

# Fixed value: the constant the sample streams carry.
SAMPLE = "SAMPLE"


def counter(spark: SparkSession, iterations: int) -> DataFrame:
    """A bounded counter, ``iteration`` = 0, 1, ..."""
    return spark.range(iterations).withColumnRenamed("id", "iteration")


def counter_over(df: DataFrame, order_by: list[str]) -> DataFrame:
    """A counter that ticks once per row of ``df``, in the given order."""
    keys = [F.expr(o).alias(f"_o{i}") for i, o in enumerate(order_by)]
    numbered = number_rows(
        df.select(F.lit(0).alias("_group"), *keys), ["_group"], [f"_o{i}" for i in range(len(keys))],
        storage.scratch_path(df.sparkSession, "counter"))
    return numbered.select(F.col(SEQ).alias("iteration"))


def counter_stream(spark: SparkSession, rows_per_batch: int, partitions: int | None = None,
                   advance_ms: int = 1000) -> DataFrame:
    """An unbounded counter; ``rows_per_batch`` limits what one micro-batch takes."""
    reader = (spark.readStream.format("rate-micro-batch")
              .option("rowsPerBatch", rows_per_batch)
              .option("advanceMillisPerBatch", advance_ms))
    if partitions:
        reader = reader.option("numPartitions", partitions)
    return reader.load().select(F.col("value").alias("iteration"))


def sample_stream(ticks: DataFrame) -> DataFrame:
    """``id``, ``id2`` and a constant name from a counter."""
    n = F.col("iteration")
    return ticks.select(n.cast("int").alias("id"), n.alias("id2"), F.lit(SAMPLE).alias("name"))


def sample_stream_optional(ticks: DataFrame) -> DataFrame:
    """The sample columns with two optional attributes that are never set."""
    n = F.col("iteration")
    return ticks.select(
        n.cast("int").alias("ID"), (n * 2).alias("ID2"), F.lit(SAMPLE).alias("NAME"),
        F.lit(None).cast("string").alias("LNAME"), F.lit(None).cast("int").alias("OPT"))


def labelled(values: DataFrame, column: str) -> DataFrame:
    """Map every value x of a list to (x, 'X' + 2x)."""
    x = F.col(column)
    return values.select(x.cast("int").alias("id"), F.concat(F.lit("X"), x * 2).alias("name"))
