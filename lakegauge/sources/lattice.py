"""A lattice of column types: the narrowest type that holds what files of several types hold.

Whole numbers widen to whole numbers, floats to doubles, decimals to decimals with the digits of both, dates to times. Only types
with nothing in common become text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.functions import times

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _decimal(t: T.DataType) -> T.DecimalType:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0)


def join(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type above both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
            return max(a, b, key=lambda t: _WHOLE.index(type(t)))
        if all(isinstance(t, (*_WHOLE, T.DecimalType)) for t in (a, b)):
            x, y = _decimal(a), _decimal(b)
            scale = max(x.scale, y.scale)
            digits = max(x.precision - x.scale, y.precision - y.scale) + scale
            return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
        return T.DoubleType()
    kinds = {type(a), type(b)}
    if kinds <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return T.TimestampNTZType() if T.TimestampNTZType in kinds else T.TimestampType()
    return T.StringType()


def joined(schemas: list[T.StructType]) -> T.StructType:
    """All columns of all schemas, in order of first appearance, each of the least type above its types."""
    kinds: dict[str, list[T.DataType]] = {}
    for s in schemas:
        for f in s:
            kinds.setdefault(f.name, []).append(f.dataType)
    return T.StructType([T.StructField(n, reduce(join, k)) for n, k in kinds.items()])


def scan_widens(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether the scan itself reads a stored type as a wider one."""
    if stored == wanted:
        return True
    if isinstance(stored, _WHOLE):
        if isinstance(wanted, _WHOLE):
            return _WHOLE.index(type(stored)) < _WHOLE.index(type(wanted))
        if isinstance(wanted, T.DecimalType):
            return wanted.precision - wanted.scale >= max(10, _DIGITS[type(stored)])
        return isinstance(wanted, T.DoubleType) and not isinstance(stored, T.LongType)
    if isinstance(stored, T.DecimalType) and isinstance(wanted, T.DecimalType):
        return wanted.scale >= stored.scale and wanted.precision - wanted.scale >= stored.precision - stored.scale
    return (type(stored), type(wanted)) in {(T.FloatType, T.DoubleType), (T.DateType, T.TimestampNTZType)}


def convert(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of one type as one of a type above it."""
    if have == want:
        return col
    if isinstance(want, T.StringType) and isinstance(have, _NESTED):
        return F.to_json(col)
    if isinstance(want, T.TimestampNTZType):
        return times.as_time(col, have)
    return col.cast(want)


def family(t: T.DataType) -> str:
    """Types that differ in width only share a family."""
    if isinstance(t, _WHOLE):
        return "whole"
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "floating"
    return "decimal" if isinstance(t, T.DecimalType) else t.simpleString()
