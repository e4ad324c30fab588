"""What several operators share: scratch tables, row keys, and the words of a text in SQL."""

from __future__ import annotations

import gc

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.numbering import SEQ, number_rows

ROW = "__tidegate_row"
_FILE, _RANK, _AT = "__tidegate_file", "__tidegate_rank", "__tidegate_place"
#: Bits of a key that hold the place of a row in its file.
_FILE_BITS = 40
#: Bytes of a narrow kept table for which one task is enough.
_TASK_BYTES = 1 << 20
#: Files whose ranks every task is told; the rows of more files are written with their keys.
_RANKED_FILES = 100_000
#: The bytes that separate words, as characters and as a regular expression class.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


class Workspace:
    """One folder in the shared scratch space, for the tables an operator rereads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path = spark, storage.scratch_path(spark, label)
        self._count = 0

    def folder(self, name: str) -> str:
        self._count += 1
        return f"{self.path}/{self._count}-{name}"

    def keep(self, df: DataFrame, name: str, like: DataFrame | None = None, times: int = 1) -> DataFrame:
        """Write and reread: cuts the lineage, survives lost executors, shows Spark the real size.

        ``like``: a table that, so many ``times``, is no smaller than ``df``. A small one is written by few tasks: the
        rounds of an iteration else pass as many almost empty files on as there are shuffle partitions.
        """
        if like is not None:
            size = str(like._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
            df = df.coalesce(min(1 + times * int(size) // _TASK_BYTES, 1 << 20))
        return self.at(df, self.folder(name))

    def at(self, df: DataFrame, path: str, *folders: str) -> DataFrame:
        """``folders``: columns by which the table is told apart in folders, so that a part is read alone."""
        df.write.mode("overwrite").option("compression", "zstd").partitionBy(*folders).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a table that ``keep`` returned and nothing will read again."""
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if self.path.split("://")[-1].removeprefix("file:") in folder:
                storage.remove(self.spark, folder)

    def release(self) -> None:
        """Free the shuffle files of finished steps, which Spark keeps until the driver collects its garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def keyed_rows(ws: Workspace, df: DataFrame, **columns: Column) -> DataFrame:
    """The given columns of ``df`` with a key of the row in ``__tidegate_row``, equal at every reading.

    A Parquet scan is keyed by its files, ranked by name, and the places of the rows in them: how
    a scan is split depends on the cores that are there when it is planned. Any other input,
    and one of very many files, is written with its keys. No row is shuffled. Other columns of
    ``df`` play no part, whatever their names.
    """
    chosen = [c.alias(name) for name, c in columns.items()]
    if df._jdf.queryExecution().optimizedPlan().nodeName().startswith(("LogicalRelation", "Relation")):
        try:
            hidden = df.metadataColumn("_metadata")
            file, place = hidden["file_path"], hidden["row_index"]
            files = df.select(file.alias("file"), place.alias("place"))
            files.schema
        except AnalysisException:           # another format, which has no places
            files = None
        if files is not None:
            files = files.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("last"))
            ranked = ws.keep(number_rows(files, [], ["file"], ws.folder("files")), "files")
            # A file that is read twice repeats its places.
            if (ranked.where(f"n <> last + 1 or n > {1 << _FILE_BITS}").isEmpty()
                    and ranked.count() <= _RANKED_FILES):
                ranked = ranked.select(F.col("file").alias(_FILE), F.col(SEQ).alias(_RANK))
                rows = df.select(*chosen, file.alias(_FILE), place.alias(_AT))
                return rows.join(F.broadcast(ranked), _FILE).select(
                    *columns, (F.shiftleft(_RANK, _FILE_BITS) + F.col(_AT)).alias(ROW))
    return ws.keep(df.select(*chosen).withColumn(ROW, F.monotonically_increasing_id()), "input")


def pinned(ws: Workspace, df: DataFrame) -> DataFrame:
    """``df`` with a key of the row in ``__tidegate_row``, as ``keyed_rows`` gives it."""
    if ROW in df.columns:
        return df
    return keyed_rows(ws, df, **{name: df[name] for name in df.columns})


def keyed(df: DataFrame, *columns: Column) -> DataFrame:
    """The given columns of a pinned ``df`` with the key of the row.

    Documents may repeat their ids, so joins back to rows use this key.
    """
    return df.select(ROW, *columns)


def words(text: Column) -> Column:
    """The words of a text, as an array; none for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_CLASS + "+"))


def tasks_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
