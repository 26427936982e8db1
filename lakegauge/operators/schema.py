"""Schema assertions: contract against the columns that are really there."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.contract import Contract
from lakegauge.session import small_table

_SPARK_KINDS = ((T.BooleanType, "boolean"), (T.DecimalType, "decimal"), (T.IntegralType, "integer"),
                (T.FractionalType, "float"), (T.StringType, "string"), (T.VarcharType, "string"),
                (T.CharType, "string"), (T.TimestampType, "datetime"), (T.TimestampNTZType, "datetime"),
                (T.DateType, "datetime"))


def logical_kind(dtype: T.DataType) -> str:
    """Logical type of a physical Spark type; anything nested is 'unsupported'."""
    return next((kind for cls, kind in _SPARK_KINDS if isinstance(dtype, cls)), "unsupported")


def logical_kind_of_footer(t: Column) -> Column:
    """Logical type of a type name from a parquet footer; a dictionary has the type of its values."""
    values = F.regexp_extract(t, r"^dictionary<values=(.*), indices=[a-z0-9]+, ordered=\w+>$", 1)
    t = F.when(values != "", values).otherwise(t)
    return (F.when(t == "bool", "boolean").when(t.startswith("decimal"), "decimal")
            .when(t.rlike("^u?int(8|16|32|64)$"), "integer").when(t.isin("halffloat", "float", "double"), "float")
            .when(t.isin("string", "large_string", "string_view"), "string").when(t.rlike("^(timestamp|date)"), "datetime")
            .otherwise("unsupported"))


_CONTRACT = pa.schema([("column", pa.string()), ("expected", pa.string())])
_ACTUAL = pa.schema([("column", pa.string()), ("actual", pa.string())])


def contract_columns(spark, c: Contract) -> DataFrame:
    return small_table(spark, [{"column": k.name, "expected": k.kind} for k in c.columns], _CONTRACT)


def schema_diff(df: DataFrame, c: Contract) -> DataFrame:
    """Per column: ok, missing, unexpected or drifted; compared by name, never by position."""
    spark = df.sparkSession
    actual = small_table(spark, [{"column": f.name, "actual": logical_kind(f.dataType)} for f in df.schema], _ACTUAL)
    return contract_columns(spark, c).join(actual, "column", "full").withColumn("status", _status())


def _status() -> Column:
    e, a = F.col("expected"), F.col("actual")
    return F.when(a.isNull(), "missing").when(e.isNull(), "unexpected").when(e != a, "drift").otherwise("ok")


def schema_diff_by_file(probed: DataFrame, c: Contract) -> DataFrame:
    """The same comparison for every file footer of an inventory, without reading data."""
    spark = probed.sparkSession
    good = probed.filter("readable")
    actual = good.select("path", F.inline("columns")).select(
        "path", F.col("name").alias("column"), logical_kind_of_footer(F.col("type")).alias("actual"))
    wanted = F.array(*[F.struct(F.lit(k.name).alias("column"), F.lit(k.kind).alias("expected")) for k in c.columns])
    expected = good.select("path", F.inline(wanted))
    return expected.join(actual, ["path", "column"], "full").withColumn("status", _status())


def missing_audit_columns(df: DataFrame, audit: list[str]) -> DataFrame:
    """Audit columns the file lacks, whatever the contract lists."""
    spark = df.sparkSession
    need = small_table(spark, [{"column": a, "expected": None} for a in audit], _CONTRACT).select("column")
    have = small_table(spark, [{"column": n, "actual": None} for n in df.schema.names], _ACTUAL).select("column")
    return need.join(have, "column", "left_anti")
