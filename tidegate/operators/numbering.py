"""Exact row numbers inside groups of any size.

``row_number() over (partition by g order by k)`` puts a whole group into one task,
so one hot group stalls the job. Here the rows are range-partitioned on (g, k), which
splits a hot group, and written once; a row's number is then its place in its
partition plus the rows of its group in earlier partitions. Only the small table of
(group, partition) sizes is ever cumulated by a window.

Writing also pins the order: the numbers stay the same when a lost executor makes
Spark read the rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART, POS, SEQ = "_part", "_pos", "_seq"
GROUP_ROWS = "_group_rows"
# monotonically_increasing_id keeps the place inside a partition in its low 33 bits.
_PLACE_MASK = (1 << 33) - 1


def place_rows(df: DataFrame) -> DataFrame:
    """Add partition number and place in the partition, as the rows lie now."""
    return df.select(
        "*",
        F.spark_partition_id().alias(PART),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_MASK)).alias(POS),
    )


def stage(df: DataFrame, group: list[str], order: list[str], path: str) -> DataFrame:
    """Write the rows once, each group contiguous in every partition.

    With ``order`` the rows are globally ordered by (group, order); without it they
    stay in the partition they arrive in and nothing is shuffled.
    """
    if order:
        # The salt splits equal keys, which range partitioning alone keeps together.
        placed = (df.withColumn("_salt", F.rand(7))
                  .repartitionByRange(*group, *order, "_salt")
                  .sortWithinPartitions(*group, *order)
                  .drop("_salt"))
    else:
        placed = df.sortWithinPartitions(*group)
    placed = place_rows(placed)
    placed.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def partition_offsets(sized: DataFrame, group: list[str]) -> DataFrame:
    """Cumulate (group, partition) sizes: rows before the partition and in the group."""
    whole = Window.partitionBy(*group)
    before = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return sized.select(
        "*",
        F.coalesce(F.sum("cnt").over(before), F.lit(0)).alias("offset"),
        F.sum("cnt").over(whole).alias(GROUP_ROWS),
    )


def number_staged(staged: DataFrame, group: list[str], path: str) -> DataFrame:
    """Add the 0-based number in the group and the size of the group.

    The offsets are written to ``path`` first: the planner then knows their real size
    and broadcasts them only below its threshold, otherwise it joins by shuffle.
    """
    spark = staged.sparkSession
    sizes = staged.groupBy(*group, PART).agg(
        F.count(F.lit(1)).alias("cnt"), F.min(POS).alias("first_pos"))
    offsets = partition_offsets(sizes, group)
    offsets.write.mode("overwrite").parquet(path)
    offsets = spark.read.schema(offsets.schema).parquet(path)
    return (staged.join(offsets, [*group, PART])
            .withColumn(SEQ, F.col("offset") + F.col(POS) - F.col("first_pos"))
            .drop("cnt", "first_pos", "offset"))


def number_rows(df: DataFrame, group: list[str], order: list[str], scratch: str) -> DataFrame:
    """``df`` plus ``_seq`` (0-based) and ``_group_rows``, for groups of any size."""
    staged = stage(df, group, order, f"{scratch}/rows")
    return number_staged(staged, group, f"{scratch}/offsets").drop(POS)
