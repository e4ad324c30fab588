"""The stored form of a target: accepted rows, results and the batch log.

Each of the three is partitioned by writer and epoch and every epoch is written by
replacing its own folder, so an epoch that runs again leaves one copy, and an epoch
that becomes empty leaves none. The log is written last: an epoch with log rows is
complete. Trials of rows lie beside them and are never read as rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..errors import IngestError, OptionError, SchemaMismatch
from ..functions.conform import quoted, spared
from ..functions.types import comparable
from ..operators.batching import LOG_SCHEMA

WRITER, EPOCH, SHARD = "_writer", "_epoch", "_shard"
INSERTED = "_Inserted_"
HIDDEN = T.StructType([
    T.StructField("_channel", T.LongType()),
    T.StructField("_part", T.IntegerType()),
    T.StructField(SHARD, T.IntegerType()),
])
ADDRESS = T.StructType([T.StructField(WRITER, T.StringType()), T.StructField(EPOCH, T.LongType())])
# Between a writer and the channel of it that commits by itself; no writer's name holds it.
CHANNEL_MARK = ".c"
# Between a writer and the places of the batches that it tries to store.
TRIAL_MARK = f"{CHANNEL_MARK}."
SPEC_PROPERTY = "tidegate.spec"
# What is stored, in the order in which it goes; the first two are catalog tables.
KINDS = ("log", "rows", "results", "marks", "keys", "tries")
CATALOGUED = KINDS[:2]


@dataclass(frozen=True)
class TableSpec:
    schema: T.StructType
    partitioning_key: tuple[str, ...]
    primary_key: tuple[str, ...] = ()
    shards: int | None = None

    def to_json(self) -> str:
        return json.dumps({
            "schema": self.schema.jsonValue(),
            "partitioning_key": list(self.partitioning_key),
            "primary_key": list(self.primary_key),
            "shards": self.shards,
        })

    @staticmethod
    def from_json(text: str) -> TableSpec:
        d = json.loads(text)
        return TableSpec(T.StructType.fromJson(d["schema"]), tuple(d["partitioning_key"]),
                         tuple(d["primary_key"]), d["shards"])


def new_spec(schema: T.StructType, partitioning_key: list[str], primary_key: list[str],
             shards: int | None) -> TableSpec:
    """Keys default to the first column and to none; unknown names are refused."""
    if not schema.fields:
        raise OptionError("a table needs at least one column")
    names = schema.fieldNames()
    if len({n.lower() for n in names}) != len(names):
        raise OptionError(f"column names repeat: {names}")
    taken = [n for n in names if n in HIDDEN.names + ADDRESS.names]
    if taken:
        raise OptionError(f"reserved column names: {', '.join(taken)}")
    for key in (*partitioning_key, *primary_key):
        if key not in names:
            raise OptionError(f"key column {key!r} is not in the table: {names}")
    return TableSpec(schema, tuple(partitioning_key or names[:1]), tuple(primary_key), shards)


def check_schema(stream: T.StructType, table: T.StructType, match: str) -> None:
    """Arity and types must agree, by position or by name; nullability is not compared."""
    if len(stream.fields) != len(table.fields):
        raise SchemaMismatch(
            f"the stream has {len(stream.fields)} attributes, the table {len(table.fields)} columns")
    by_name = {f.name: f for f in stream.fields}
    for i, column in enumerate(table.fields):
        attribute = by_name.get(column.name) if match == "name" else stream.fields[i]
        if attribute is None:
            raise SchemaMismatch(f"table column {column.name!r} is not in the stream: {sorted(by_name)}")
        if comparable(attribute.dataType) != comparable(column.dataType):
            raise SchemaMismatch(
                f"stream attribute {attribute.name} : {attribute.dataType.simpleString()} does not "
                f"match table column {column.name} : {column.dataType.simpleString()}")


class TableStore:
    """A target named in the catalog or kept under a path."""

    def __init__(self, spark: SparkSession, *, table: str | None = None,
                 database: str | None = None, path: str | None = None):
        if bool(table) == bool(path):
            raise OptionError("name a target: either table or path")
        self.spark = spark
        self.name = f"{database}.{table}" if table and database else table
        self.path = path.rstrip("/") if path else None
        self._root: dict[str, str] | None = None
        self._spec: TableSpec | None = None

    # -- existence and definition ------------------------------------------------

    def exists(self) -> bool:
        if self.path:
            return storage.exists(self.spark, f"{self.path}/spec")
        if self.spark.catalog.tableExists(self._catalog("rows")):
            return True
        if self.spark.catalog.tableExists(self.name):
            raise IngestError(f"table {self.name} exists but was not created by an insert; "
                              "create it with create_table or choose another name")
        return False

    def create(self, spec: TableSpec) -> None:
        self._spec = spec
        if self.path:
            storage.write_text(self.spark, f"{self.path}/spec", spec.to_json())
            return
        self._create_catalog_table("rows", T.StructType(spec.schema.fields + HIDDEN.fields), spec)
        self._create_catalog_table("log", LOG_SCHEMA, None)
        columns = ", ".join(f"`{n}`" for n in spec.schema.fieldNames())
        self.spark.sql(f"CREATE VIEW IF NOT EXISTS {self.name} AS "
                       f"SELECT {columns} FROM {self._catalog('rows')}")

    def _create_catalog_table(self, kind: str, schema: T.StructType, spec: TableSpec | None) -> None:
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in schema.fields)
        properties = ""
        if spec is not None:
            text = spec.to_json().replace("\\", "\\\\").replace("'", "\\'")
            properties = (f" TBLPROPERTIES ('{SPEC_PROPERTY}' = '{text}',"
                          f" 'tidegate.partitioning_key' = '{','.join(spec.partitioning_key)}',"
                          f" 'tidegate.primary_key' = '{','.join(spec.primary_key)}')")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._catalog(kind)} ({columns}, "
            f"{WRITER} STRING, {EPOCH} BIGINT) USING parquet "
            f"PARTITIONED BY ({WRITER}, {EPOCH}){properties}")

    def spec(self) -> TableSpec:
        if self._spec is None:
            if self.path:
                text = self.spark.read.text(f"{self.path}/spec").first()[0]
            else:
                text = self._describe("rows")["table_properties"][SPEC_PROPERTY]
            self._spec = TableSpec.from_json(text)
        return self._spec

    def _catalog(self, kind: str) -> str:
        return f"{self.name}__{kind}"

    def _describe(self, kind: str) -> dict:
        text = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._catalog(kind)} AS JSON").first()[0]
        return json.loads(text)

    def location(self, kind: str) -> str:
        if self.path:
            return f"{self.path}/{kind}"
        if self._root is None:
            self._root = {k: self._describe(k)["location"] for k in ("rows", "log")}
        if kind not in CATALOGUED:
            return self._root["rows"].rstrip("/").removesuffix("__rows") + f"__{kind}"
        return self._root[kind]

    def epoch_path(self, kind: str, writer: str, epoch: int) -> str:
        return f"{self.location(kind)}/{WRITER}={writer}/{EPOCH}={epoch}"

    # -- writing -----------------------------------------------------------------

    def write_epoch(self, kind: str, df: DataFrame, writer: str, epoch: int,
                    mode: str = "overwrite") -> None:
        """Replace an epoch, or append to it; what a failed job wrote does not show.

        Rows of a trial go to a folder of their own. One that can't be evaluated does not fail its job
        there, but is NULL in all columns but ``_part``, which holds the place of its batch.
        """
        if kind == "rows" and TRIAL_MARK in writer:
            kind, part = "tries", HIDDEN["_part"].name
            row = spared(F.struct(*[quoted(n) for n in df.columns if n != part])).alias("_row")
            df = df.select(part, row).select(part, "_row.*")
        df.write.mode(mode).parquet(self.epoch_path(kind, writer, epoch))
        self._register(kind, writer, epoch)

    def refused(self, writer: str, epoch: int) -> DataFrame:
        """Places of the batches of a trial that have a row which can't be evaluated: of a row that was
        written, the channel is never NULL."""
        tried = self.spark.read.schema("_part bigint, _channel bigint").parquet(self.epoch_path("tries", writer, epoch))
        return tried.where("_channel is null").select(F.col("_part").alias("_place")).distinct()

    def write_beside(self, kind: str, df: DataFrame, writer: str, epoch: int, partition: str) -> None:
        """Write what belongs to an epoch and is in no catalog, in folders by one column."""
        df.write.mode("overwrite").partitionBy(partition).parquet(self.epoch_path(kind, writer, epoch))

    def read_beside(self, kind: str, schema: T.StructType, epochs: list[tuple[str, int]]) -> DataFrame:
        folders = [self.epoch_path(kind, *address) for address in epochs]
        return self.spark.read.schema(schema).option("basePath", self.location(kind)).parquet(*folders)

    def epochs(self, kind: str) -> set[tuple[str, int]]:
        """Addresses of the epochs of which something of the kind is completely written."""
        found = storage.matching(self.spark, f"{self.location(kind)}/{WRITER}=*/{EPOCH}=*/*")
        names = [path.split("/")[-3:] for path in found]
        return {(w.partition("=")[2], int(e.partition("=")[2])) for w, e, last in names
                if not last.startswith("_temporary")}

    def parts_of(self, kind: str, partition: str) -> set[str]:
        """Values of the column that ``write_beside`` made folders of."""
        found = storage.matching(self.spark, f"{self.location(kind)}/{WRITER}=*/{EPOCH}=*/{partition}=*")
        return {path.rpartition("=")[2] for path in found}

    def drop_epoch(self, kind: str, writer: str, epoch: int) -> None:
        storage.remove(self.spark, self.epoch_path(kind, writer, epoch))
        if self.name and kind in CATALOGUED:
            self.spark.sql(f"ALTER TABLE {self._catalog(kind)} DROP IF EXISTS "
                           f"PARTITION ({WRITER} = '{writer}', {EPOCH} = {epoch})")

    def forget_writer(self, writer: str) -> None:
        """Drop every epoch of a writer: its log, rows, results and keys."""
        for kind in KINDS:
            for name in self.writers(kind, writer):
                folder = f"{self.location(kind)}/{WRITER}={name}"
                known = storage.children(self.spark, folder)
                storage.remove(self.spark, folder)
                if self.name and kind in CATALOGUED and known:
                    self.spark.sql(f"ALTER TABLE {self._catalog(kind)} DROP IF EXISTS "
                                   f"PARTITION ({WRITER} = '{name}')")

    def writers(self, kind: str, writer: str) -> list[str]:
        """A writer that has stored something, and the writers of its channels."""
        found = storage.matching(self.spark, f"{self.location(kind)}/{WRITER}={writer}*")
        names = [path.rpartition("=")[2] for path in found]
        return [n for n in names if n == writer or n.startswith(f"{writer}{CHANNEL_MARK}")]

    def _register(self, kind: str, writer: str, epoch: int) -> None:
        if self.name and kind in CATALOGUED:
            self.spark.sql(f"ALTER TABLE {self._catalog(kind)} ADD IF NOT EXISTS "
                           f"PARTITION ({WRITER} = '{writer}', {EPOCH} = {epoch})")
            self.spark.catalog.refreshTable(self._catalog(kind))

    # -- reading -----------------------------------------------------------------

    def _read(self, kind: str, schema: T.StructType, writer: str | None,
              epoch: int | None) -> DataFrame:
        """One of the three datasets; only the folders of the writer and epoch are listed."""
        full = T.StructType(schema.fields + ADDRESS.fields)
        base = self.location(kind)
        folders = [base]
        if writer is not None:
            folders = [f"{base}/{WRITER}={name}" for name in self.writers(kind, writer)]
        if epoch is not None:
            folders = [f"{folder}/{EPOCH}={epoch}" for folder in folders]
        folders = [folder for folder in folders if storage.exists(self.spark, folder)]
        if not folders:
            return self.spark.range(0).select(
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in full.fields])
        return self.spark.read.schema(full).option("basePath", base).parquet(*folders)

    def _read_catalog(self, kind: str, writer: str | None, epoch: int | None) -> DataFrame:
        df = self.spark.table(self._catalog(kind))
        if writer is not None:
            df = df.where((F.col(WRITER) == writer) | F.col(WRITER).startswith(f"{writer}{CHANNEL_MARK}"))
        return df if epoch is None else df.where(F.col(EPOCH) == epoch)

    def stored_rows(self, writer: str | None = None, epoch: int | None = None) -> DataFrame:
        """Accepted rows with the helper and address columns."""
        if self.name:
            return self._read_catalog("rows", writer, epoch)
        fields = self.spec().schema.fields + HIDDEN.fields
        return self._read("rows", T.StructType(fields), writer, epoch)

    def epoch_rows(self, writer: str, epoch: int) -> DataFrame:
        """The rows of one epoch, read from its folder."""
        fields = self.spec().schema.fields + HIDDEN.fields
        return (self.spark.read.schema(T.StructType(fields))
                .parquet(self.epoch_path("rows", writer, epoch)))

    def rows(self, committed_only: bool = False) -> DataFrame:
        """The user-facing table."""
        stored = self.stored_rows()
        if committed_only:
            complete = self.log().select(WRITER, EPOCH).distinct()
            stored = stored.join(complete, [WRITER, EPOCH], "left_semi")
        return stored.select(*[F.col(f"`{n}`") for n in self.spec().schema.fieldNames()])

    def log(self, writer: str | None = None, epoch: int | None = None) -> DataFrame:
        if self.name:
            return self._read_catalog("log", writer, epoch)
        return self._read("log", LOG_SCHEMA, writer, epoch)

    def results(self, input_schema: T.StructType, writer: str, epoch: int | None) -> DataFrame:
        fields = [*input_schema.fields, T.StructField(INSERTED, T.BooleanType())]
        return self._read("results", T.StructType(fields), writer, epoch)

    def next_epoch(self, writer: str) -> int:
        """One past the last complete epoch; an unfinished one is run again."""
        folder = f"{self.location('log')}/{WRITER}={writer}"
        epochs = [int(name.partition("=")[2]) for name in storage.children(self.spark, folder)
                  if name.startswith(f"{EPOCH}=")]
        for epoch in sorted(epochs, reverse=True):
            written = storage.children(self.spark, f"{folder}/{EPOCH}={epoch}")
            if any(not name.startswith("_temporary") for name in written):
                return epoch + 1
        return 0
