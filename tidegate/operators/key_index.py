"""An index of the primary keys of every epoch, so that de-duplication reads few stored keys.

Beside its rows a large epoch keeps its keys in files by hash bucket (the keys of a small one are read from
its rows), and every epoch a mark for every slot of about ``SLOT_KEYS`` of them: the range of the first key column, and a bitmap of the
hashes. A new epoch marks its own keys the same way. Only buckets with a slot whose range overlaps
and whose bitmap shares a bit with the new one's can hold one of its keys; only their files
are read, for an exact anti-join. A mark takes about a byte a key, and the ranges prune the bitmaps
where keys grow with time. Marks are written last: an epoch with marks is indexed. Committed epochs
without marks (inserted without de-duplication) are indexed when first met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conform import quoted
from ..sources.tables import EPOCH, WRITER, TableStore

#: Keys of a slot and of a bucket, about; files that are named one by one, beyond which the
#: epochs with a hit are read whole.
SLOT_KEYS, BUCKET_KEYS, NAMED_FILES = 4096, 1_000_000, 10_000
SLOTS, BUCKET = "_slots", "_bucket"
#: The bucket of keys that are read from the rows; epochs up to which ranges are not looked at beforehand.
IN_ROWS, FEW_EPOCHS = -1, 8
_SLOT_BITS = 32_768


def _power(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def key_names(keys: list[str]) -> list[str]:
    """Names of the key columns in the index."""
    return [f"_key{i}" for i in range(len(keys))]


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*[quoted(k).alias(n) for k, n in zip(keys, key_names(keys))])


def _marks(named: DataFrame, slots: Column, *also: str) -> DataFrame:
    """One row a slot (and value of ``also``): ranges of the first key column and bits of the hashes.

    The low bits of a hash name the slot, so the slots of one epoch split those of a smaller one.
    """
    h = F.xxhash64(*[c for c in named.columns if c.startswith("_key")])
    return (named.withColumn("_h", h).withColumn(SLOTS, slots).withColumn("slot", F.expr(f"pmod(_h, {SLOTS})"))
            .groupBy(SLOTS, "slot", *also).agg(
                F.min("_key0").alias("lo"), F.max("_key0").alias("hi"), F.max(F.col("_key0").isNull()).alias("nulls"),
                F.bitmap_construct_agg(F.expr(f"pmod(shiftright(_h, 40), {_SLOT_BITS}L)")).alias("bits")))


def index_epoch(store: TableStore, writer: str, epoch: int, n: int | None = None) -> None:
    """Write the marks of a stored epoch of ``n`` rows, and its keys if they fill several buckets."""
    keys = list(store.spec().primary_key)
    rows = store.stored_rows(writer, epoch)
    n = rows.count() if n is None else n
    slots, buckets = _power(-(-n // SLOT_KEYS)), _power(-(-n // BUCKET_KEYS))
    named, bucket = _named(rows, keys), F.lit(IN_ROWS).cast("bigint")
    if buckets > 1:
        placed = named.withColumn(BUCKET, F.expr(f"pmod(xxhash64({', '.join(named.columns)}), {buckets}L)"))
        store.write_beside("keys", placed.repartition(BUCKET), writer, epoch, partition=BUCKET)
        bucket = F.expr(f"pmod(slot, {buckets}L)")
    marks = _marks(named, F.lit(slots).cast("bigint")).withColumn(BUCKET, bucket)
    store.write_beside("marks", marks, writer, epoch, partition=SLOTS)


def _mark_schema(first: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("slot", T.LongType()), T.StructField("lo", first), T.StructField("hi", first),
        T.StructField("nulls", T.BooleanType()), T.StructField("bits", T.BinaryType()),
        T.StructField(BUCKET, T.LongType()), T.StructField(WRITER, T.StringType()),
        T.StructField(EPOCH, T.LongType()), T.StructField(SLOTS, T.LongType())])


def _in_range(marks: DataFrame, named: DataFrame) -> DataFrame:
    """Marks that overlap the range of all keys: bounds as literals, so that Parquet skips the bitmaps
    of the others."""
    first = named.schema["_key0"].dataType
    bounds = named.agg(F.min("_key0").alias("lo"), F.max("_key0").alias("hi"),
                       F.max(F.col("_key0").isNull()).alias("nulls")).first()
    near = F.lit(False) if bounds["lo"] is None else (
        (F.col("hi") >= F.lit(bounds["lo"]).cast(first)) & (F.col("lo") <= F.lit(bounds["hi"]).cast(first)))
    return marks.where(near | F.col("nulls") if bounds["nulls"] else near)


def matching_buckets(incoming: DataFrame, store: TableStore, keys: list[str], writer: str,
                     epoch: int) -> list[str]:
    """Folders of the key files that may hold a key of ``incoming``, of other committed epochs."""
    others = store.epochs("log") - {(writer, epoch)}
    if not others:
        return []
    indexed = store.epochs("marks")
    for address in sorted(others - indexed):
        index_epoch(store, *address)
    named = _named(incoming, keys)
    marks = store.read_beside("marks", _mark_schema(named.schema["_key0"].dataType), sorted(others))
    if len(others) > FEW_EPOCHS:
        marks = _in_range(marks, named)
    sizes = sorted(store.parts_of("marks", SLOTS))
    asked = _marks(named.withColumn("_size", F.explode(F.array(*[F.lit(int(s)).cast("bigint") for s in sizes]))),
                   F.col("_size"))
    asked = asked.select(SLOTS, "slot", *[F.col(c).alias(f"asked_{c}") for c in ("lo", "hi", "nulls", "bits")])
    overlap = ((F.col("hi") >= F.col("asked_lo")) & (F.col("lo") <= F.col("asked_hi"))
               | F.col("nulls") & F.col("asked_nulls"))
    met = marks.join(asked, [SLOTS, "slot"]).where(overlap)
    hits = (met.select(WRITER, EPOCH, BUCKET, "slot", F.explode(F.array("bits", "asked_bits")).alias("bits"))
            .groupBy(WRITER, EPOCH, BUCKET, "slot").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("shared"))
            .where("shared > 0").select(WRITER, EPOCH, BUCKET).distinct())
    found = hits.limit(NAMED_FILES + 1).collect()
    if len(found) > NAMED_FILES:                                    # one row an epoch
        found = hits.groupBy(WRITER, EPOCH).agg(F.min(F.when(F.col(BUCKET) == IN_ROWS, F.col(BUCKET))).alias(BUCKET)).collect()
    return sorted({_folder(store, r[WRITER], r[EPOCH], r[BUCKET]) for r in found})


def _folder(store: TableStore, writer: str, epoch: int, bucket: int | None) -> str:
    if bucket == IN_ROWS:
        return store.epoch_path("rows", writer, epoch)
    return store.epoch_path("keys", writer, epoch) + ("" if bucket is None else f"/{BUCKET}={bucket}")


def without_stored_keys(rows: DataFrame, incoming: DataFrame, store: TableStore, keys: list[str],
                        writer: str, epoch: int) -> DataFrame:
    """``rows`` whose key no other committed epoch holds; ``incoming``: the rows before they
    were reduced to one a key, which is cheaper to read."""
    folders = matching_buckets(incoming, store, keys, writer, epoch)
    if not folders:
        return rows
    for kind, names in (("rows", keys), ("keys", key_names(keys))):
        read = [f for f in folders if f.startswith(store.location(kind).rstrip("/") + "/")]
        if read:
            schema = T.StructType([T.StructField(n, rows.schema[k].dataType) for k, n in zip(keys, names)])
            stored = store.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*read)
            rows = anti_join(rows, stored.toDF(*key_names(keys)), keys)
    return rows


def anti_join(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose key is not among the stored ones, which have the names of ``key_names``."""
    same = [quoted(k).eqNullSafe(F.col(n)) for k, n in zip(keys, key_names(keys))]
    return rows.join(stored, same, "left_anti")
