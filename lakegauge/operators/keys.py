"""Uniqueness and distinct counts, one two-step aggregation per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, group: list[str], key: list[str]) -> DataFrame:
    """Rows per group and key. Partial aggregation folds a hot key before the shuffle."""
    return df.groupBy(*group, *key).agg(F.count(F.lit(1)).alias("_cnt"))


def uniqueness(df: DataFrame, group: list[str], key: list[str], rule_id: str) -> DataFrame:
    """Every row of a repeated key is unexpected; rows with all key columns null are not tested.

    Typed keys, no string encoding; the table is read once with only the key columns.
    """
    present = F.lit(False)
    for k in key:
        present = present | F.col(k).isNotNull()
    dup = F.when(present & (F.col("_cnt") > 1), F.col("_cnt")).otherwise(0)
    tested = F.sum(F.when(present, F.col("_cnt")).otherwise(0))
    per = key_counts(df, group, key).groupBy(*group).agg(
        F.sum("_cnt").alias("element_count"), F.sum(F.when(present, 0).otherwise(F.col("_cnt"))).alias("missing_count"),
        F.sum(dup).alias("unexpected_count"), F.try_divide(F.sum(dup) * 100.0, tested).alias("unexpected_percent"),
        F.count_if(present).alias("observed_num"))
    return per.select(*group, F.lit(rule_id).alias("rule_id"), "element_count", "missing_count", "unexpected_count",
                      "unexpected_percent", (F.col("unexpected_count") == 0).alias("success"),
                      F.col("observed_num").cast("double").alias("observed_num"))


def distinct_count(df: DataFrame, group: list[str], column: str, name: str = "distinct_count") -> DataFrame:
    """Exact number of distinct non-null values per group."""
    return (df.select(*group, column).groupBy(*group, column).count()
            .groupBy(*group).agg(F.count(column).alias(name)))


def approx_distinct_count(df: DataFrame, group: list[str], column: str, rsd: float = 0.02) -> DataFrame:
    """HyperLogLog++ estimate for tables where the exact shuffle is not worth it."""
    return df.groupBy(*group).agg(F.approx_count_distinct(column, rsd).alias("distinct_count"))


def duplicate_rows(df: DataFrame, group: list[str], key: list[str], limit: int = 0) -> DataFrame:
    """Surplus rows (rows minus distinct keys) per group against a limit."""
    return key_counts(df, group, key).groupBy(*group).agg(
        F.sum("_cnt").alias("element_count"),
        F.sum(F.col("_cnt") - 1).alias("surplus_rows")).withColumn("success", F.col("surplus_rows") <= limit)


def key_stability(df: DataFrame, part: str, key: list[str]) -> DataFrame:
    """Is a key that is unique inside every partition also unique over the whole history?"""
    counts = key_counts(df, [part], key)
    whole = counts.groupBy(*key).agg(F.sum("_cnt").alias("_rows"), F.max("_cnt").alias("_in_part"))
    return whole.agg(F.sum("_rows").alias("row_count"), F.count(F.lit(1)).alias("distinct_keys"),
                     (F.max("_in_part") <= 1).alias("unique_per_partition"),
                     (F.max("_rows") <= 1).alias("unique_overall"))
