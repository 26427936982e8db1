"""Membership of values and value pairs in master tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.operators.onepass import value_counts  # noqa: F401  (counts that the functions below take)

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def pair_counts(df: DataFrame, group: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """(group, relation, a, b, count) for several column pairs in one scan."""
    items = F.array(*[F.struct(F.lit(f"{a}->{b}").alias("relation"), F.col(a).cast("string").alias("a"),
                               F.col(b).cast("string").alias("b")) for a, b in pairs])
    return df.select(*group, F.inline(items)).groupBy(*group, "relation", "a", "b").agg(
        F.count(F.lit(1)).alias("_cnt"))


def _verdict(known: DataFrame, by: list[str], tested, hit) -> DataFrame:
    n = F.col("_cnt")
    bad = F.sum(F.when(tested & ~hit, n).otherwise(0))
    return known.groupBy(*by).agg(
        F.sum(n).alias("element_count"), F.sum(F.when(tested, 0).otherwise(n)).alias("missing_count"),
        bad.alias("unexpected_count"),
        F.try_divide(bad * 100.0, F.sum(F.when(tested, n).otherwise(0))).alias("unexpected_percent"),
        F.count_if(tested & hit).alias("known_values"), F.count_if(tested & ~hit).alias("unknown_values"),
    ).withColumn("success", F.col("unexpected_count") == 0)


def against_master(counts: DataFrame, group: list[str], master: DataFrame) -> DataFrame:
    """Counts of values absent from ``master(column, code)``.

    Counts are folded by value first, so the join sees distinct codes: a code on a third of the
    rows is one row here. No broadcast hint: the planner measures the master.
    """
    known = counts.join(master.select("column", "code").distinct().withColumn("_hit", F.lit(True)),
                        ["column", "code"], "left")
    return _verdict(known, [*group, "column"], F.col("code").isNotNull(), F.col("_hit").isNotNull())


def pairs_against(counts: DataFrame, group: list[str], mapping: DataFrame) -> DataFrame:
    """Counts of pairs absent from ``mapping(relation, a, b)``; a pair with both sides null is not tested."""
    m = mapping.select("relation", "a", "b").distinct().withColumn("_hit", F.lit(True))
    known = counts.join(m, ["relation", "a", "b"], "left")
    tested = F.col("a").isNotNull() | F.col("b").isNotNull()
    return _verdict(known, [*group, "relation"], tested, F.col("_hit").isNotNull())


def same_set(counts: DataFrame, group: list[str], master: DataFrame) -> DataFrame:
    """Does the set of values of each group equal the master set, in both directions?"""
    sizes = master.select("column", "code").distinct().groupBy("column").agg(F.count("code").alias("master_values"))
    found = against_master(counts, group, master)
    return found.join(sizes, "column").select(
        *group, "column", "known_values", "unknown_values", "master_values",
        ((F.col("unknown_values") == 0) & (F.col("known_values") == F.col("master_values"))).alias("success"))


def _common_type(a: T.DataType, b: T.DataType) -> str:
    """Type in which two key columns are compared: numbers and dates as such where both sides agree, otherwise text."""
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return "bigint"
    return "date" if isinstance(a, T.DateType) and isinstance(b, T.DateType) else "string"


def referential(df: DataFrame, group: list[str], column: str, master: DataFrame, key: str) -> DataFrame:
    """Rows whose value is missing from another table's column.

    Two whole-number or two date columns are compared as they are, which equals their comparison as text; any other pair is
    compared as text.
    """
    kind = _common_type(df.schema[column].dataType, master.schema[key].dataType)
    codes = master.select(F.lit(column).alias("column"), F.col(key).cast(kind).alias("code")).filter("code IS NOT NULL")
    counts = df.groupBy(*group, F.col(column).cast(kind).alias("code")).agg(F.count(F.lit(1)).alias("_cnt")).withColumn(
        "column", F.lit(column))
    return against_master(counts, group, codes)


def code_list(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null codes of the history, as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("code")) for c in columns])
    return df.select(F.inline(pairs)).filter("code IS NOT NULL").distinct()


def relation_map(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Distinct (a, b) pairs of the history with both sides present."""
    return pair_counts(df, [], pairs).filter("a IS NOT NULL AND b IS NOT NULL").drop("_cnt")


def relation_violations(mapping: DataFrame) -> DataFrame:
    """Left values that map to more than one right value. Only such values are gathered."""
    many = mapping.groupBy("relation", "a").agg(F.count(F.lit(1)).alias("targets")).filter("targets > 1")
    return many
