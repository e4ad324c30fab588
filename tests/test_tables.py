"""Creating tables and agreeing with existing ones."""

import pytest
from pyspark.sql import functions as F

import tidegate as tg
from tidegate.errors import IngestError, OptionError, SchemaMismatch
from tidegate.sources.tables import TableStore


def test_created_from_the_stream(spark, name):
    df = spark.range(3).select(F.col("id").cast("int"), F.lit("x").alias("s"))
    tg.insert(df, name, schema="int32 id, optional<rstring> s", primary_key=" id ", shards=2)
    spec = TableStore(spark, table=name).spec()
    assert spec.schema["id"].nullable is False and spec.schema["s"].nullable is True
    assert (spec.partitioning_key, spec.primary_key, spec.shards) == (("id",), ("id",), 2)
    assert spark.table(name).columns == ["id", "s"]
    assert spark.table(name).count() == 3
    properties = {r.key: r.value for r in spark.sql(f"show tblproperties {name}__rows").collect()}
    assert properties["tidegate.primary_key"] == "id"


def test_keys_count_at_creation_only(spark, target):
    tg.insert(spark.range(2), path=target, partitioning_key="id")
    tg.insert(spark.range(2), path=target, primary_key="id", shards=7)
    spec = TableStore(spark, path=target).spec()
    assert spec.primary_key == () and spec.shards is None


def test_database_prefix(spark, name):
    spark.sql("create database if not exists other")
    tg.insert(spark.range(4), name, database="other")
    assert spark.table(f"other.{name}").count() == 4
    assert tg.read_table(spark, name, database="other").count() == 4


def test_created_beforehand(spark, target):
    tg.create_table(spark, "int32 id, optional<rstring> name", path=target, primary_key="id")
    tg.create_table(spark, "int32 id, rstring name", path=target)
    with pytest.raises(SchemaMismatch):
        tg.create_table(spark, "int64 id, rstring name", path=target)
    df = spark.createDataFrame([(1, None)], "id int, name string")
    assert tg.insert(df, path=target).rows.count() == 1
    missing = spark.createDataFrame([(None, "x")], "id int, name string")
    assert tg.insert(missing, path=target).rows.count() == 0


@pytest.mark.parametrize("query", [
    "select 1 id, 'a' name, 2 more",                 # one column more
    "select 1 id",                                   # one less
    "select 'x' id, 'a' name",                       # text for a number
    "select cast(1 as smallint) id, 'a' name",       # narrower, although it would fit
    "select cast(1 as bigint) id, 'a' name",         # wider
])
def test_clashing_streams_are_refused(spark, name, query):
    tg.insert(spark.sql("select 1 id, 'a' name"), name)
    with pytest.raises(SchemaMismatch):
        tg.insert(spark.sql(query), name)
    assert spark.table(name).count() == 1


def test_mismatch_names_both_sides(spark, target):
    tg.insert(spark.sql("select 1 id"), path=target)
    with pytest.raises(SchemaMismatch, match="attribute other : string.*column id : int"):
        tg.insert(spark.sql("select 'x' other"), path=target)


def test_match_by_position_ignores_names(spark, target):
    tg.insert(spark.sql("select 1 a, 2 b"), path=target)
    tg.insert(spark.sql("select 3 b, 4 a"), path=target)
    assert sorted(map(tuple, tg.read_table(spark, path=target).collect())) == [(1, 2), (3, 4)]


def test_match_by_name(spark, target):
    tg.insert(spark.sql("select 1 a, 2 b"), path=target)
    done = tg.insert(spark.sql("select 3 b, 4 a"), path=target, match="name")
    assert done.rows.first().asDict() == {"a": 4, "b": 3}
    assert done.results.first().asDict() == {"b": 3, "a": 4, "_Inserted_": True}
    with pytest.raises(SchemaMismatch, match="'b' is not in the stream"):
        tg.insert(spark.sql("select 3 c, 4 a"), path=target, match="name")


def test_element_nullability_does_not_clash(spark, target):
    tg.insert(spark.sql("select array(1) l"), path=target)
    tg.insert(spark.createDataFrame([([1, None],)], "l array<int>"), path=target)
    assert tg.read_table(spark, path=target).count() == 2


def test_unknown_key_column(spark, target):
    with pytest.raises(OptionError, match="'nope'"):
        tg.insert(spark.range(1), path=target, primary_key="id, nope")


def test_foreign_table_is_not_touched(spark, name):
    spark.range(1).write.saveAsTable(name)
    with pytest.raises(IngestError, match="not created by an insert"):
        tg.insert(spark.range(1), name)
    assert spark.table(name).count() == 1


def test_epochs_append_and_replace(spark, target):
    assert tg.insert(spark.range(5), path=target, writer="batch").epoch == 0
    assert tg.insert(spark.range(5, 7), path=target, writer="batch").epoch == 1
    assert tg.read_table(spark, path=target).count() == 7
    tg.insert(spark.range(3), path=target, epoch=0)
    assert tg.read_table(spark, path=target).count() == 5
    assert tg.insert(spark.range(1), path=target, writer="other").epoch == 0
    assert tg.read_table(spark, path=target).count() == 6


@pytest.mark.parametrize("catalog", [False, True])
def test_replay_with_nothing_accepted_empties_the_epoch(spark, name, target, catalog):
    where = {"table": name} if catalog else {"path": target}
    tg.insert(spark.range(10), epoch=0, order_by="id", **where)
    done = tg.insert(spark.range(10), epoch=0, order_by="id", reject_when="true", **where)
    assert tg.read_table(spark, **where).count() == 0
    assert done.metrics["rows_failed"] == 10
    tg.insert(spark.range(0), epoch=0, order_by="id", **where)
    assert tg.read_table(spark, **where).count() == 0
    assert tg.read_log(spark, **where).count() == 0


def test_unfinished_epoch_is_taken_again(spark, target):
    tg.insert(spark.range(5), path=target, writer="batch")
    store = TableStore(spark, path=target)
    store.drop_epoch("log", "batch", 0)            # as if the log had never been written
    assert tg.read_table(spark, path=target).count() == 5
    assert tg.read_table(spark, path=target, committed_only=True).count() == 0
    assert tg.insert(spark.range(3), path=target, writer="batch").epoch == 0
    assert tg.read_table(spark, path=target, committed_only=True).count() == 3


@pytest.mark.parametrize("catalog", [False, True])
def test_forget_a_writer(spark, name, target, catalog):
    where = {"table": name} if catalog else {"path": target}
    tg.insert(spark.range(5), writer="a", **where)
    tg.insert(spark.range(2), writer="b", **where)
    tg.forget(spark, writer="a", **where)
    assert tg.read_table(spark, **where).count() == 2
    assert tg.insert(spark.range(1), writer="a", **where).epoch == 0


def test_copying_a_table_into_itself(spark, name):
    df = spark.range(100).select("id", F.lit(200).alias("u"))
    tg.insert(df, name, schema="int64 id, optional<int16> u")
    done = tg.insert(spark.table(name), name, order_by="id", batch_size=10, reject_when="id = 55")
    assert (done.rows.count(), done.results.count()) == (90, 100)
    assert spark.table(name).count() == 190


def test_shards_keep_a_key_together(spark, target):
    df = spark.range(2000).select((F.col("id") % 50).alias("k"), "id")
    done = tg.insert(df, path=target, partitioning_key="k", shards=4)
    stored = done.store.stored_rows()
    assert stored.groupBy("k").agg(F.countDistinct("_shard").alias("n")).where("n <> 1").isEmpty()
    assert stored.select("_shard").distinct().count() == 4
    assert stored.count() == 2000


def test_key_audit(spark, target):
    df = spark.sql("select * from values (1, 1), (1, 2), (1, 1), (2, null), (2, null) t(a, b)")
    rows = tg.insert(df, path=target, primary_key="a,b").rows
    assert sorted(map(tuple, tg.audit_keys(rows, ["a", "b"]).collect()), key=str) == [
        (1, 1, 2), (2, None, 2)]


def test_inserts_at_the_same_time_keep_all_rows(spark, target):
    from concurrent.futures import ThreadPoolExecutor

    tg.create_table(spark, "int64 id", path=target)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: tg.insert(spark.range(k, k + 500), path=target), (0, 500)))
    assert sorted(r[0] for r in tg.read_table(spark, path=target).collect()) == list(range(1000))
    assert sum(r["n_rows"] for r in tg.read_log(spark, path=target).collect()) == 1000
