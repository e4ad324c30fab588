"""The projection that turns stream attributes into table columns.

Everything is a built-in column expression, so the whole projection stays in one
code-generated stage. Where a conversion can lose a value (a number that does not
fit, text that is no number) the plan also carries a predicate that is true for
such a value; the row is then rejected instead of being stored as NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaMismatch, UnsupportedType
from .types import PRIMITIVES, UNSIGNED_BITS, StreamType

INTEGRAL_RANK = {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3}
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)
TIMES = (T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Conversion:
    """How one value travels: its new form, when it fails, and whether it can be undone."""

    apply: Callable[[Column], Column]
    fails: Callable[[Column], Column] | None = None
    lossless: bool = False
    identity: bool = False


@dataclass(frozen=True)
class ColumnPlan:
    source: str
    source_type: T.DataType
    target: str
    target_type: T.DataType
    expr: Column
    fails: Column | None
    lossless: bool
    may_be_null: bool


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def spared(value: Column) -> Column:
    """``value``, or NULL in rows where evaluating it raises an error, which would else fail the task.

    SQL's own ``try_`` functions are made of this expression, which has no name of its own there.
    """
    jvm = SparkContext._active_spark_context._jvm
    bridge = jvm.org.apache.spark.sql.classic.ExpressionUtils
    return Column(bridge.column(jvm.org.apache.spark.sql.catalyst.expressions.TryEval(bridge.expression(value._jc))))


def _wrap_unsigned(bits: int, target: T.DataType) -> Callable[[Column], Column]:
    """Keep the low bits and read them as two's complement."""
    spare = 64 - bits
    return lambda c: F.shiftright(F.shiftleft(c.cast("bigint"), spare), spare).cast(target)


def _wrap_unsigned_decimal(bits: int, target: T.DataType) -> Callable[[Column], Column]:
    span = F.expr(f"cast({2 ** bits} as decimal(38,0))")
    half = F.expr(f"cast({2 ** (bits - 1)} as decimal(38,0))")

    def wrap(c: Column) -> Column:
        low = F.pmod(c.cast("decimal(38,0)"), span)
        return F.when(low >= half, low - span).otherwise(low).cast(target)

    return wrap


def _truncate_to_millis(dtype: T.DataType) -> Callable[[Column], Column]:
    if isinstance(dtype, T.TimestampNTZType):
        return lambda c: c - F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.extract(F.lit("SECOND"), c) % F.lit(0.001).cast("decimal(8,6)"))
    return lambda c: F.date_trunc("millisecond", c)


def convert_primitive(source: T.DataType, name: str, timestamp_precision: str) -> Conversion:
    target = PRIMITIVES[name][0]
    if name in UNSIGNED_BITS:
        bits = UNSIGNED_BITS[name]
        if isinstance(source, T.DecimalType) and source.scale == 0:
            return Conversion(_wrap_unsigned_decimal(bits, target))
        if type(source) not in INTEGRAL_RANK:
            raise UnsupportedType(f"{source.simpleString()} cannot be read as {name}")
        if source == target:
            return Conversion(lambda c: c, lossless=True, identity=True)
        return Conversion(_wrap_unsigned(bits, target))
    if isinstance(target, TIMES) and timestamp_precision == "ms":
        base = convert_primitive(source, name, "us")
        truncate = _truncate_to_millis(target)
        return Conversion(lambda c: truncate(base.apply(c)), base.fails)
    if source == target:
        return Conversion(lambda c: c, lossless=True, identity=True)
    if isinstance(source, T.StringType) and isinstance(target, T.StringType):
        return Conversion(lambda c: c.cast(target), lossless=True)
    if type(source) in INTEGRAL_RANK and type(target) in INTEGRAL_RANK:
        if INTEGRAL_RANK[type(source)] <= INTEGRAL_RANK[type(target)]:
            return Conversion(lambda c: c.cast(target), lossless=True)
        return _checked(target, lossless=True)
    if isinstance(source, T.FloatType) and isinstance(target, T.DoubleType):
        return Conversion(lambda c: c.cast(target), lossless=True)
    if isinstance(source, TIMES) and isinstance(target, TIMES):
        return Conversion(lambda c: c.cast(target))
    if isinstance(target, T.StringType) and isinstance(source, NUMERIC + TIMES + (T.BooleanType,)):
        return Conversion(lambda c: c.cast(target))
    if isinstance(source, NUMERIC) and isinstance(target, NUMERIC):
        return _checked(target)
    if isinstance(source, T.StringType):
        return _checked(target)
    raise UnsupportedType(f"{source.simpleString()} cannot be converted to {name}")


def _checked(target: T.DataType, lossless: bool = False) -> Conversion:
    return Conversion(
        lambda c: c.try_cast(target),
        lambda c: c.isNotNull() & c.try_cast(target).isNull(),
        lossless,
    )


def convert(source: T.DataType, wanted: StreamType, timestamp_precision: str) -> Conversion:
    if not wanted.is_collection:
        return convert_primitive(source, wanted.name, timestamp_precision)
    if wanted.name == "map":
        if not isinstance(source, T.MapType):
            raise UnsupportedType(f"{source.simpleString()} cannot be converted to a map")
        key = convert_primitive(source.keyType, wanted.elements[0], timestamp_precision)
        value = convert_primitive(source.valueType, wanted.elements[1], timestamp_precision)
        return _map_conversion(key, value)
    if not isinstance(source, T.ArrayType):
        raise UnsupportedType(f"{source.simpleString()} cannot be converted to a {wanted.name}")
    element = convert_primitive(source.elementType, wanted.elements[0], timestamp_precision)
    return _array_conversion(element, as_set=wanted.name == "set")


def _array_conversion(element: Conversion, as_set: bool) -> Conversion:
    def apply(c: Column) -> Column:
        moved = c if element.identity else F.transform(c, element.apply)
        return F.sort_array(F.array_distinct(moved)) if as_set else moved

    fails = None
    if element.fails is not None:
        fails = lambda c: F.coalesce(F.exists(c, element.fails), F.lit(False))
    plain = element.identity and not as_set
    return Conversion(apply, fails, element.lossless and not as_set, plain)


def _map_conversion(key: Conversion, value: Conversion) -> Conversion:
    def apply(c: Column) -> Column:
        moved = c if value.identity else F.transform_values(c, lambda _, v: value.apply(v))
        return moved if key.identity else F.transform_keys(moved, lambda k, _: key.apply(k))

    checks = []
    if key.fails is not None:
        checks.append(lambda c: F.exists(F.map_keys(c), key.fails))
    if not key.identity:
        # Keys that become equal can't share a map; the row is bad, not the job.
        checks.append(lambda c: F.size(F.array_distinct(F.transform(F.map_keys(c), key.apply))) < F.size(F.map_keys(c)))
    if value.fails is not None:
        checks.append(lambda c: F.exists(F.map_values(c), value.fails))
    fails = None
    if checks:
        fails = lambda c: F.coalesce(
            reduce(Column.__or__, [check(c) for check in checks]), F.lit(False))
    return Conversion(apply, fails, key.lossless and value.lossless,
                      key.identity and value.identity)


def plan_columns(
    input_schema: T.StructType,
    columns: list[tuple[str, StreamType]],
    *,
    match: str = "position",
    optional_mode: str = "null",
    timestamp_precision: str = "us",
) -> list[ColumnPlan]:
    """Pair every declared column with an input column and plan its conversion."""
    if len(columns) != len(input_schema.fields):
        raise SchemaMismatch(
            f"the stream has {len(input_schema.fields)} attributes but "
            f"{len(columns)} columns are declared")
    by_name = {f.name: f for f in input_schema.fields}
    plans = []
    for (name, wanted), positional in zip(columns, input_schema.fields):
        source = by_name.get(name) if match == "name" else positional
        if source is None:
            raise SchemaMismatch(f"column {name!r} is not in the stream: {sorted(by_name)}")
        step = convert(source.dataType, wanted, timestamp_precision)
        value = quoted(source.name)
        expr = step.apply(value)
        fills_zero = (optional_mode == "zero" and wanted.optional and source.nullable
                      and isinstance(wanted.spark_type, NUMERIC + (T.BooleanType,)))
        if fills_zero:
            zero = F.lit(False) if wanted.name == "boolean" else F.lit(0).cast(wanted.spark_type)
            expr = F.coalesce(expr, zero)
        plans.append(ColumnPlan(
            source=source.name,
            source_type=source.dataType,
            target=name,
            target_type=wanted.spark_type,
            expr=expr,
            fails=None if step.fails is None else step.fails(value),
            lossless=step.lossless and not fills_zero,
            may_be_null=source.nullable and not fills_zero,
        ))
    return plans


def conform(df, plans: list[ColumnPlan], keep: tuple[str, ...] = ()):
    """One select: the table columns, then the named helper columns untouched."""
    return df.select(*[p.expr.alias(p.target) for p in plans], *keep)
