"""De-duplication against the key index: exact results, and few key files read."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

import tidegate as tg
from tidegate.operators import key_index
from tidegate.sources.tables import TableStore


def keys_of(spark, target):
    return sorted(r.k for r in tg.read_table(spark, path=target).collect())


def matching(store, df):
    return key_index.matching_buckets(df, store, ["k"], "none", 0)


@pytest.fixture
def small_slots(monkeypatch):
    monkeypatch.setattr(key_index, "SLOT_KEYS", 16)
    monkeypatch.setattr(key_index, "BUCKET_KEYS", 64)


def test_only_epochs_that_can_match_are_read(spark, target, small_slots):
    options = {"path": target, "primary_key": "k", "dedupe_on_key": True}
    for first in (0, 1000, 2000):
        tg.insert(spark.range(first, first + 300).toDF("k"), **options)
    store = TableStore(spark, path=target)
    assert len(store.epochs("marks")) == 3
    assert matching(store, spark.range(5000, 5100).toDF("k")) == []
    # Keys that grow with time: a second delivery meets the buckets of one epoch only.
    met = matching(store, spark.range(1000, 1300).toDF("k"))
    assert len({p.split("/_bucket=")[0] for p in met}) == 1 and len(met) == 8
    # One key meets one bucket of it, and the plan reads that bucket's file.
    one = spark.range(1100, 1101).toDF("k")
    met = matching(store, one)
    assert len(met) == 1
    left = key_index.without_stored_keys(one, one, store, ["k"], "none", 0)
    files = spark.read.option("recursiveFileLookup", "true").parquet(*met).inputFiles()
    assert left.count() == 0 and set(left.inputFiles()) >= set(files) and len(files) <= 4
    # A key that isn't stored, inside the range of an epoch: the bitmap says so.
    gaps = spark.createDataFrame([(5.5,)], "k double")
    tg.insert(spark.range(0, 300).select(F.col("id").cast("double").alias("k")), path=f"{target}-d",
              primary_key="k", dedupe_on_key=True)
    assert matching(TableStore(spark, path=f"{target}-d"), gaps) == []


@pytest.mark.parametrize("kind", ["bigint", "string", "double", "timestamp"])
def test_every_type_of_key(spark, target, small_slots, kind):
    rng = random.Random(1)
    make = {"bigint": lambda i: i, "string": lambda i: f"k{i}'\"\\", "double": lambda i: float("nan") if i == 7 else i / 3,
            "timestamp": lambda i: datetime.datetime(2020, 1, 1) + datetime.timedelta(seconds=i, microseconds=i)}[kind]
    seen = set()
    for _ in range(3):
        values = [None if i == 0 else make(i) for i in (rng.randrange(400) for _ in range(150))]
        seen |= set(map(str, values))
        tg.insert(spark.createDataFrame([(v,) for v in values], f"k {kind}"), path=target, primary_key="k",
                  dedupe_on_key=True)
    stored = [str(r.k) for r in tg.read_table(spark, path=target).collect()]
    assert len(stored) == len(seen) and set(stored) == seen


def test_keys_of_several_columns(spark, target, small_slots):
    options = {"path": target, "primary_key": "a, k", "dedupe_on_key": True}
    df = spark.range(400).select((F.col("id") % 5).alias("a"), (F.col("id") % 40).cast("string").alias("k"))
    tg.insert(df, **options)
    tg.insert(df.withColumn("a", F.col("a") + 3), **options)
    pairs = {(i % 5, str(i % 40)) for i in range(400)}
    pairs |= {(a + 3, k) for a, k in pairs}
    assert sorted((r.a, r.k) for r in tg.read_table(spark, path=target).collect()) == sorted(pairs)


def test_epochs_without_marks_are_indexed_when_met(spark, target):
    tg.insert(spark.range(50).toDF("k"), path=target, primary_key="k")
    store = TableStore(spark, path=target)
    assert store.epochs("marks") == set()
    tg.insert(spark.range(30, 80).toDF("k"), path=target, dedupe_on_key=True)
    assert keys_of(spark, target) == list(range(80))
    assert len(store.epochs("marks")) == 2


def test_an_epoch_that_is_replaced_is_indexed_anew(spark, target):
    options = {"path": target, "primary_key": "k", "dedupe_on_key": True}
    tg.insert(spark.range(50).toDF("k"), epoch=0, **options)
    tg.insert(spark.range(100, 150).toDF("k"), epoch=0, **options)
    tg.insert(spark.range(40, 110).toDF("k"), **options)
    assert keys_of(spark, target) == list(range(40, 150))
    tg.forget(spark, path=target, writer="batch")
    tg.insert(spark.range(0, 150).toDF("k"), **options)
    assert keys_of(spark, target) == list(range(150))


def test_empty_epochs(spark, target):
    options = {"path": target, "primary_key": "k", "dedupe_on_key": True}
    for n in (0, 5, 0, 5):
        tg.insert(spark.range(n).toDF("k"), **options)
    assert keys_of(spark, target) == list(range(5))


def test_many_hits_read_whole_epochs(spark, target, small_slots, monkeypatch):
    monkeypatch.setattr(key_index, "NAMED_FILES", 2)
    options = {"path": target, "primary_key": "k", "dedupe_on_key": True}
    for _ in range(2):
        tg.insert(spark.range(500).toDF("k"), **options)
    assert keys_of(spark, target) == list(range(500))
