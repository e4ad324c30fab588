"""The public entry points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import storage
from .errors import OptionError
from .functions.types import split_keys, stream_columns, table_schema
from .operators.sink import insert_batch
from .options import resolve
from .sources.tables import TableStore, check_schema, new_spec
from .streaming.stream import EpochWriter, checkpoint_writer, insert_stream


def insert(df: DataFrame, table: str | None = None, **options):
    """Insert a batch or streaming DataFrame into a table or a path.

    Options: ``schema`` (declared stream types), ``database``, ``path``,
    ``partitioning_key``, ``primary_key``, ``shards``, ``batch_size``, ``channels``,
    ``order_by``, ``reject_when``, ``on_failure``, ``optional_mode``,
    ``timestamp_precision``, ``match``, ``dedupe_on_key``, ``dry_run``, ``results``,
    ``track_batches``, ``evaluate_once``, ``epoch``, ``writer``, ``checkpoint``,
    ``trigger``, ``config``. The README explains each.
    """
    resolved = resolve(df.sparkSession, table=table, **options)
    return insert_stream(df, resolved) if df.isStreaming else insert_batch(df, resolved)


def epoch_writer(df: DataFrame, table: str | None = None, **options) -> EpochWriter:
    """The ``foreachBatch`` function of a streaming insert, to compose with other steps."""
    resolved = resolve(df.sparkSession, table=table, **options)
    return EpochWriter(df, resolved)


def create_table(spark: SparkSession, schema, table: str | None = None, *,
                 database: str | None = None, path: str | None = None, partitioning_key=None,
                 primary_key=None, shards: int | None = None) -> TableStore:
    """Create a target from a stream schema; an existing one must agree with it."""
    store = TableStore(spark, table=table, database=database, path=path)
    wanted = table_schema(stream_columns(schema, None))
    if store.exists():
        check_schema(wanted, store.spec().schema, "position")
    else:
        store.create(new_spec(wanted, split_keys(partitioning_key), split_keys(primary_key), shards))
    return store


def read_table(spark: SparkSession, table: str | None = None, *, database: str | None = None,
               path: str | None = None, committed_only: bool = False) -> DataFrame:
    """Accepted rows of every insert; optionally of completed epochs only."""
    return TableStore(spark, table=table, database=database, path=path).rows(committed_only)


def read_log(spark: SparkSession, table: str | None = None, *, database: str | None = None,
             path: str | None = None) -> DataFrame:
    """The write log of every insert, one row per batch."""
    return TableStore(spark, table=table, database=database, path=path).log()


def forget(spark: SparkSession, table: str | None = None, *, database: str | None = None,
           path: str | None = None, writer: str | None = None, checkpoint: str | None = None) -> None:
    """Back to the initial state: drop what one writer, or the stream of a checkpoint, wrote.

    The checkpoint goes too, so that the stream reads its input again.
    """
    if bool(writer) == bool(checkpoint):
        raise OptionError("name either the writer or the checkpoint of the stream")
    store = TableStore(spark, table=table, database=database, path=path)
    store.forget_writer(writer or checkpoint_writer(spark, checkpoint))
    if checkpoint:
        storage.remove(spark, checkpoint)
