"""Numeric coercion and a monotone bucket function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def no_nan(col: Column, dtype: T.DataType) -> Column:
    """NaN counts as missing."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def as_number(col: Column, dtype: T.DataType) -> Column:
    """The value as double, null where it is not a number (text needs a plain decimal literal)."""
    if isinstance(dtype, T.StringType):
        return F.when(col.rlike(_NUMBER), F.trim(col).try_cast("double"))
    if is_numeric(dtype) or isinstance(dtype, T.BooleanType):
        return no_nan(col.cast("double"), T.DoubleType())
    return F.lit(None).cast("double")


def log_bucket(col: Column, per_octave: int = 64) -> Column:
    """Bucket number that never decreases as the value grows.

    Logarithmic in the magnitude, so the bucket count follows the spread of the exponents and
    not the row count; infinities get the outermost buckets.
    """
    size = F.floor(F.log2(F.abs(col)) * per_octave) + F.lit(1100 * per_octave)
    top = F.lit(2200 * per_octave)
    size = F.when(F.abs(col) == float("inf"), top).otherwise(size)
    return F.when(col == 0, F.lit(0)).when(col > 0, size).otherwise(-size).cast("bigint")


def bytes_text(col: Column) -> Column:
    """Byte count in GB, MB, KB or B."""
    def unit(div: float, name: str) -> Column:
        return F.concat(F.format_string("%.2f", col / F.lit(div)), F.lit(" " + name))
    return (F.when(col >= 1e9, unit(1e9, "GB")).when(col >= 1e6, unit(1e6, "MB"))
            .when(col >= 1e3, unit(1e3, "KB")).otherwise(F.concat(col.cast("bigint").cast("string"), F.lit(" B"))))
