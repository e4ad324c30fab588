"""Primary and partitioning keys: layout, audit and opt-in de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conform import quoted
from ..sources.tables import SHARD, TableSpec


def shard_of(spec: TableSpec) -> Column:
    """The shard a row belongs to; every row of a key has the same one."""
    if not spec.shards:
        return F.lit(None).cast("int")
    keys = [quoted(k) for k in spec.partitioning_key]
    return F.pmod(F.xxhash64(*keys), F.lit(spec.shards)).cast("int")


def lay_out(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the shard and bring the rows of a shard together.

    A rebalance rather than a plain repartition: adaptive execution splits the shard
    of a hot key over several tasks and merges small ones.
    """
    rows = rows.withColumn(SHARD, shard_of(spec))
    return rows.hint("rebalance", F.col(SHARD)).sortWithinPartitions(SHARD) if spec.shards else rows


def audit_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Key values stored more than once, with their number of copies."""
    return (table.groupBy(*[quoted(k) for k in keys])
            .agg(F.count(F.lit(1)).alias("copies"))
            .where("copies > 1"))


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the lowest by ``order``, or any when there is no order.

    Both forms reduce copies inside each task before the shuffle, so a key with very
    many copies sends one row per task.
    """
    if not order:
        return rows.dropDuplicates(keys)
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    chosen = F.min_by(F.struct(*[quoted(c) for c in rows.columns]), rank).alias("_row")
    return (rows.groupBy(*[quoted(k).alias(f"_k{i}") for i, k in enumerate(keys)])
            .agg(chosen).select("_row.*"))
