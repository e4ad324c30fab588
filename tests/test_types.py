"""Type surface: tokens, refusals, row sizes and key lists."""

import pytest
from pyspark.sql import types as T

from tidegate.errors import UnsupportedType
from tidegate.functions.types import (comparable, default_batch_size, from_spark, parse_schema,
                                      parse_type, split_keys, table_schema)


@pytest.mark.parametrize("token, expected", [
    ("boolean", T.BooleanType()), ("int8", T.ByteType()), ("uint8", T.ByteType()),
    ("int16", T.ShortType()), ("uint16", T.ShortType()), ("int32", T.IntegerType()),
    ("uint32", T.IntegerType()), ("int64", T.LongType()), ("uint64", T.LongType()),
    ("float32", T.FloatType()), ("float64", T.DoubleType()), ("timestamp", T.TimestampType()),
    ("rstring", T.StringType()), ("ustring", T.StringType()),
    ("list<int32>", T.ArrayType(T.IntegerType())), ("set<rstring>", T.ArrayType(T.StringType())),
    ("map<rstring, int64>", T.MapType(T.StringType(), T.LongType())),
])
def test_supported_types(token, expected):
    assert parse_type(token).spark_type == expected
    optional = parse_type(f"optional<{token}>")
    assert optional.spark_type == expected and optional.optional


@pytest.mark.parametrize("token", [
    "decimal32", "decimal64", "decimal128", "complex32", "complex64", "blob", "xml", "enum",
    "tuple<int32 a>", "list<list<int32>>", "map<rstring, list<int32>>", "set<map<int32,int32>>",
    "list<int32>[5]", "optional<optional<int32>>", "map<int32>", "list<int32, int32>", "date", "",
])
def test_refused_tokens(token):
    with pytest.raises(UnsupportedType):
        parse_type(token)


@pytest.mark.parametrize("dtype", [
    T.DecimalType(10, 2), T.StructType([T.StructField("a", T.IntegerType())]), T.BinaryType(),
    T.DateType(), T.DayTimeIntervalType(), T.ArrayType(T.ArrayType(T.IntegerType())),
    T.MapType(T.StringType(), T.ArrayType(T.IntegerType())), T.ArrayType(T.DateType()),
])
def test_refused_spark_types(dtype):
    with pytest.raises(UnsupportedType):
        from_spark(dtype, True)


def test_schema_text_with_and_without_tuple():
    plain = parse_schema("int32 id, optional<int64> id2, map<rstring,int64> m, rstring name")
    assert plain == parse_schema("tuple<int32 id, optional<int64> id2, map<rstring,int64> m, rstring name>")
    assert [n for n, _ in plain] == ["id", "id2", "m", "name"]
    assert [f.nullable for f in table_schema(plain)] == [False, True, False, False]


@pytest.mark.parametrize("schema, size", [
    ("int32 id, int64 id2, rstring name", 409),
    ("int32 ID, optional<int64> ID2, rstring NAME, optional<rstring> LNAME, optional<int32> OPT", 256),
    ("int32 id, rstring name", 682),
    ("int64 id, rstring val", 512),
    ("int32 a, int32 b", 1024),
    ("boolean a, int8 b, uint16 c, float32 d, list<int8> e", 512),
])
def test_default_batch_size(schema, size):
    assert default_batch_size(parse_schema(schema)) == size


def test_default_batch_size_of_wide_rows_is_one():
    assert default_batch_size([(f"c{i}", parse_type("int64")) for i in range(2000)]) == 1


def test_element_nullability_is_not_compared():
    a = T.ArrayType(T.MapType(T.StringType(), T.LongType(), True), True)
    b = T.ArrayType(T.MapType(T.StringType(), T.LongType(), False), False)
    assert comparable(a) == comparable(b)


def test_key_lists_keep_order():
    assert split_keys(" col1, col2 ") == ["col1", "col2"]
    assert split_keys(["b", "a"]) == ["b", "a"]
    assert split_keys("") == [] and split_keys(None) == []
