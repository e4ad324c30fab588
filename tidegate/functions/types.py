"""Stream types, their Spark table types, and what is derived from a type alone."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

from ..errors import UnsupportedType

# Primitive stream type -> (Spark table type, bytes counted towards a row).
PRIMITIVES: dict[str, tuple[T.DataType, int]] = {
    "boolean": (T.BooleanType(), 1),
    "int8": (T.ByteType(), 1),
    "int16": (T.ShortType(), 2),
    "int32": (T.IntegerType(), 4),
    "int64": (T.LongType(), 8),
    "uint8": (T.ByteType(), 1),
    "uint16": (T.ShortType(), 2),
    "uint32": (T.IntegerType(), 4),
    "uint64": (T.LongType(), 8),
    "float32": (T.FloatType(), 4),
    "float64": (T.DoubleType(), 8),
    "timestamp": (T.TimestampType(), 8),
    "timestamp_ntz": (T.TimestampNTZType(), 8),
    "rstring": (T.StringType(), 8),
    "ustring": (T.StringType(), 8),
}
# Bytes counted for a collection, bytes aimed at per batch, largest batch.
COLLECTION_BYTES = 8
BATCH_BYTES = 8192
MAX_BATCH_SIZE = 200_000

UNSIGNED_BITS = {"uint8": 8, "uint16": 16, "uint32": 32, "uint64": 64}
COLLECTION_ARITY = {"list": 1, "set": 1, "map": 2}


@dataclass(frozen=True)
class StreamType:
    """One attribute type: a primitive, or a one-level list, set or map of primitives."""

    name: str
    elements: tuple[str, ...] = field(default=())
    optional: bool = False

    @property
    def is_collection(self) -> bool:
        return self.name in COLLECTION_ARITY

    @property
    def spark_type(self) -> T.DataType:
        parts = [PRIMITIVES[e][0] for e in self.elements]
        if self.name == "map":
            return T.MapType(parts[0], parts[1], True)
        if self.is_collection:
            return T.ArrayType(parts[0], True)
        return PRIMITIVES[self.name][0]

    @property
    def row_bytes(self) -> int:
        return COLLECTION_BYTES if self.is_collection else PRIMITIVES[self.name][1]


def split_outside_brackets(text: str) -> list[str]:
    """Split at commas that are not inside ``<...>``."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append(text[start:i].strip())
            start = i + 1
    parts.append(text[start:].strip())
    return [p for p in parts if p]


def parse_type(token: str) -> StreamType:
    """``"optional<int64>"``, ``"list<rstring>"``, ``"map<rstring, int64>"`` ..."""
    text = token.strip()
    generic = re.fullmatch(r"(\w+)\s*<(.*)>", text)
    if generic is None:
        if text not in PRIMITIVES:
            raise UnsupportedType(f"type {token!r} cannot be stored in a table column")
        return StreamType(text)
    outer, inner = generic.group(1), generic.group(2)
    if outer == "optional":
        held = parse_type(inner)
        if held.optional:
            raise UnsupportedType(f"type {token!r}: an optional cannot hold an optional")
        return StreamType(held.name, held.elements, optional=True)
    names = split_outside_brackets(inner)
    if COLLECTION_ARITY.get(outer) != len(names):
        raise UnsupportedType(f"type {token!r} cannot be stored in a table column")
    parsed = [parse_type(n) for n in names]
    if any(p.is_collection for p in parsed):
        raise UnsupportedType(f"type {token!r}: only one level of nesting is supported")
    return StreamType(outer, tuple(p.name for p in parsed))


def parse_schema(text: str) -> list[tuple[str, StreamType]]:
    """``"int32 id, optional<int64> id2, rstring name"``, with or without ``tuple<...>``."""
    wrapped = re.fullmatch(r"\s*tuple\s*<(.*)>\s*", text, re.S)
    columns = []
    for attribute in split_outside_brackets(wrapped.group(1) if wrapped else text):
        found = re.fullmatch(r"(.+[\s>])(\w+)", attribute, re.S)
        if found is None:
            raise UnsupportedType(f"attribute {attribute!r} is not '<type> <name>'")
        columns.append((found.group(2), parse_type(found.group(1))))
    return columns


def _primitive_name(dtype: T.DataType) -> str | None:
    # Collations are a property of a string column, not another type.
    if type(dtype) is T.StringType:
        return "rstring"
    for name, (spark_type, _) in PRIMITIVES.items():
        if spark_type == dtype:
            return name
    return None


def from_spark(dtype: T.DataType, nullable: bool) -> StreamType:
    """The stream type of an existing DataFrame column."""
    if isinstance(dtype, T.ArrayType):
        element = _primitive_name(dtype.elementType)
        if element:
            return StreamType("list", (element,), nullable)
    elif isinstance(dtype, T.MapType):
        key, value = _primitive_name(dtype.keyType), _primitive_name(dtype.valueType)
        if key and value:
            return StreamType("map", (key, value), nullable)
    else:
        name = _primitive_name(dtype)
        if name:
            return StreamType(name, (), nullable)
    raise UnsupportedType(f"type {dtype.simpleString()!r} cannot be stored in a table column")


def stream_columns(declared, input_schema: T.StructType) -> list[tuple[str, StreamType]]:
    """Normalise every accepted way to declare a stream schema.

    ``declared`` is None (the input's own types), a schema string, a mapping or
    list of ``(name, type token)``, or a ``StructType``.
    """
    if declared is None:
        declared = input_schema
    if isinstance(declared, T.StructType):
        return [(f.name, from_spark(f.dataType, f.nullable)) for f in declared.fields]
    if isinstance(declared, str):
        return parse_schema(declared)
    pairs = declared.items() if isinstance(declared, dict) else declared
    return [(name, t if isinstance(t, StreamType) else parse_type(t)) for name, t in pairs]


def table_schema(columns: list[tuple[str, StreamType]]) -> T.StructType:
    """Table columns for a stream; only a top-level optional makes a column nullable."""
    return T.StructType([T.StructField(n, t.spark_type, t.optional) for n, t in columns])


def default_batch_size(columns: list[tuple[str, StreamType]]) -> int:
    """Rows that fit into one batch's worth of bytes, at least one."""
    return max(1, BATCH_BYTES // sum(t.row_bytes for _, t in columns))


def comparable(dtype: T.DataType) -> T.DataType:
    """The type without the nullability of elements and map values."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(comparable(dtype.elementType), False)
    if isinstance(dtype, T.MapType):
        return T.MapType(comparable(dtype.keyType), comparable(dtype.valueType), False)
    return dtype


def split_keys(keys) -> list[str]:
    """Key columns from a list or a comma-separated string, order kept."""
    if keys is None:
        return []
    parts = keys.split(",") if isinstance(keys, str) else list(keys)
    return [p.strip() for p in parts if p.strip()]
