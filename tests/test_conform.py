"""Values of every supported type, stored and read back."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import tidegate as tg
from tidegate.errors import SchemaMismatch, UnsupportedType


def stored(df, path, schema=None, **options):
    return tg.insert(df, path=path, schema=schema, **options)


def test_every_type(spark, target):
    df = spark.sql("""
        select true b, 200 u8, 40000 u16, cast(3000000000 as bigint) u32,
               cast(18446744073709551615 as decimal(20,0)) u64, -5 i8, 300 i16, 7 i32,
               cast(1 as bigint) i64, cast(1.5 as float) f32, 2.25d f64,
               timestamp'2024-01-02 03:04:05.123456' ts, 'x' r, 'ü' u,
               array(1, 2, 2) l, array('b', 'a', 'b') s, map('k', cast(1 as bigint)) m""")
    done = stored(df, target, (
        "boolean b, uint8 u8, uint16 u16, uint32 u32, uint64 u64, int8 i8, int16 i16, int32 i32, "
        "int64 i64, float32 f32, float64 f64, timestamp ts, rstring r, ustring u, list<int32> l, "
        "set<rstring> s, map<rstring,int64> m"))
    row = done.rows.first()
    assert (row.u8, row.u16, row.u32, row.u64) == (-56, -25536, -1294967296, -1)
    assert (row.b, row.i8, row.i16, row.i32, row.i64, row.f32, row.f64) == (
        True, -5, 300, 7, 1, 1.5, 2.25)
    assert row.ts == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert (row.r, row.u, row.l, row.s, row.m) == ("x", "ü", [1, 2, 2], ["a", "b"], {"k": 1})


@pytest.mark.parametrize("bits, name", [(8, "uint8"), (16, "uint16"), (32, "uint32")])
def test_unsigned_wraps_over_the_whole_range(spark, target, bits, name):
    edge = [0, 1, 2 ** (bits - 1) - 1, 2 ** (bits - 1), 2 ** bits - 1]
    df = spark.createDataFrame([(v,) for v in edge], "v bigint")
    done = stored(df, target, f"{name} v", order_by="v")
    signed = [v - 2 ** bits if v >= 2 ** (bits - 1) else v for v in edge]
    assert sorted(r.v for r in done.rows.collect()) == sorted(signed)
    # The result stream carries the values as they came.
    assert sorted(r.v for r in done.results.collect()) == edge


def test_unsigned_64_from_decimal(spark, target):
    from decimal import Decimal
    edge = [0, 2 ** 63 - 1, 2 ** 63, 2 ** 64 - 1]
    df = spark.createDataFrame([(Decimal(v),) for v in edge], "v decimal(20,0)")
    rows = stored(df, target, "uint64 v").rows.collect()
    assert sorted(r.v for r in rows) == sorted([0, 2 ** 63 - 1, -2 ** 63, -1])


def test_unsigned_elements(spark, target):
    df = spark.sql("select array(1, 255, 128) v")
    assert stored(df, target, "list<uint8> v").rows.first().v == [1, -1, -128]


def test_optional_null_and_zero(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, None, None, None, None)], "id int, n bigint, b boolean, s string, t timestamp")
    schema = ("int32 id, optional<int64> n, optional<boolean> b, optional<rstring> s, "
              "optional<timestamp> t")
    null = stored(df, str(tmp_path / "a"), schema).rows.first()
    zero = stored(df, str(tmp_path / "b"), schema, optional_mode="zero")
    assert (null.n, null.b, null.s, null.t) == (None, None, None, None)
    first = zero.rows.first()
    assert (first.n, first.b, first.s, first.t) == (0, False, None, None)
    # What came in is still visible in the results.
    assert zero.results.first().n is None


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamp_precision(spark, tmp_path, kind):
    df = spark.sql(f"select cast('1969-12-31 23:59:59.123456' as {kind}) t")
    micro = stored(df, str(tmp_path / "us"), f"{kind} t").rows.first().t
    milli = stored(df, str(tmp_path / "ms"), f"{kind} t", timestamp_precision="ms").rows.first().t
    assert (micro.microsecond, milli.microsecond) == (123456, 123000)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamp_precision_inside_a_list(spark, target, kind):
    df = spark.sql(f"select array(cast('2024-01-01 00:00:00.987654' as {kind})) t")
    done = stored(df, target, f"list<{kind}> t", timestamp_precision="ms")
    assert done.rows.first().t[0].microsecond == 987000
    assert done.results.first().t[0].microsecond == 987654


def test_nullable_collections(spark, target):
    df = spark.createDataFrame([(1, None), (2, [1, None])], "id int, l array<int>")
    rows = {r.id: r.l for r in stored(df, target, "int32 id, optional<list<int32>> l").rows.collect()}
    assert rows == {1: None, 2: [1, None]}


def test_value_that_does_not_fit_rejects_its_batch(spark, target):
    df = spark.range(4).select("id", F.when(F.col("id") == 3, 1000).otherwise(1).alias("v"))
    done = stored(df, target, "int64 id, optional<int8> v", order_by="id", batch_size=2)
    assert sorted(r.id for r in done.rows.collect()) == [0, 1]
    assert {(r.id, r.v): r._Inserted_ for r in done.results.collect()} == {
        (0, 1): True, (1, 1): True, (2, 1): False, (3, 1000): False}


def test_text_that_is_no_number_rejects_inside_collections(spark, target):
    df = spark.createDataFrame(
        [(0, ["1"], {"a": "1"}), (1, ["x"], {"a": "1"}), (2, ["1"], {"a": "y"}), (3, None, None)],
        "id bigint, l array<string>, m map<string,string>")
    done = stored(df, target, "int64 id, optional<list<int32>> l, optional<map<rstring,int64>> m",
                  order_by="id", batch_size=1)
    assert sorted(r.id for r in done.rows.collect()) == [0, 3]


@pytest.mark.parametrize("schema, query", [
    ("list<int32> a", "select 1 a"), ("map<int32,int32> a", "select array(1) a"),
    ("uint8 a", "select 1.5d a"), ("boolean a", "select 1 a"), ("int32 a", "select current_date() a"),
])
def test_refused_conversions(spark, target, schema, query):
    with pytest.raises(UnsupportedType):
        stored(spark.sql(query), target, schema)


def test_declared_arity_must_agree(spark, target):
    with pytest.raises(SchemaMismatch, match="1 attributes"):
        stored(spark.range(1), target, "int64 id, int64 other")


def test_names_with_odd_characters(spark, target):
    df = spark.sql("select 1 as `a.b`, 'x' as `c d`")
    done = tg.insert(df, path=target, reject_when="`a.b` > 5")
    assert done.rows.first().asDict() == {"a.b": 1, "c d": "x"}
    assert done.results.first()._Inserted_ is True
