"""Frames and SQL fragments shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.operators import onepass
from lakegauge.operators.prepare import PART, PART_DATE, with_partition


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def daily_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events in daily partitions, with gaps: 'error' types and values above 150 are missing."""
    e = table(spark, sf, "events")
    e = e.withColumns({"event_type": F.expr("nullif(event_type, 'error')"),
                       "value": F.expr("CASE WHEN value <= 150 THEN value END")})
    return with_partition(e, F.to_date("ts"))


# the same frame for the SQL side
DAILY_EVENTS = """(SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type,
  CASE WHEN value <= 150 THEN value END AS value, props, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events) e"""


def rule_table(df: DataFrame, rules: list, group: str = PART, name: str = "day") -> DataFrame:
    """Counts of row rules in the form the SQL twins produce."""
    out = onepass.grouped_checks(df, [group], rules)
    return out.select(F.col(group).cast("string").alias(name), "rule_id", "element_count", "missing_count",
                      "unexpected_count", F.round("unexpected_percent", 6).alias("unexpected_percent"), "success")


def rule_sql(source: str, group: str, items: list[tuple[str, str, str]], name: str = "day") -> str:
    """(rule id, tested condition, bad condition) per rule."""
    parts = []
    for rule_id, tested, bad in items:
        t, b = f"({tested})", f"(({tested}) AND coalesce(({bad}), false))"
        parts.append(f"""SELECT CAST({group} AS VARCHAR) AS {name}, '{rule_id}' AS rule_id,
  CAST(count(*) AS BIGINT) AS element_count, CAST(count(*) FILTER (WHERE NOT {t}) AS BIGINT) AS missing_count,
  CAST(count(*) FILTER (WHERE {b}) AS BIGINT) AS unexpected_count,
  round(100.0 * count(*) FILTER (WHERE {b}) / nullif(count(*) FILTER (WHERE {t}), 0), 6) AS unexpected_percent,
  count(*) FILTER (WHERE {b}) = 0 AS success FROM {source} GROUP BY 1""")
    return "\nUNION ALL\n".join(parts)


__all__ = ["DAILY_EVENTS", "PART", "PART_DATE", "daily_events", "rule_sql", "rule_table", "table"]
