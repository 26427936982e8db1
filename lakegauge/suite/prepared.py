"""Prepared columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakegauge.contract import parse_contract
from lakegauge.functions import numbers, times
from lakegauge.operators.prepare import expected_column, number_column, prepare
from lakegauge.suite import query
from lakegauge.suite.common import table

_CANDIDATES = """(SELECT o_orderpriority, o_orderpriority AS v FROM orders
  UNION ALL SELECT o_orderpriority, substr(o_orderpriority, 1, 1) FROM orders
  UNION ALL SELECT o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) FROM orders
  UNION ALL SELECT o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) || 'd' FROM orders
  UNION ALL SELECT o_orderpriority, ' ' || substr(o_orderpriority, 1, 1) || 'e2 ' FROM orders
  UNION ALL SELECT o_orderpriority, NULL FROM orders) c"""


@query("prepare_number", f"""
SELECT o_orderpriority AS priority, CAST(count(*) AS BIGINT) AS "rows",
  CAST(count(*) FILTER (WHERE regexp_matches(v, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')) AS BIGINT) AS numbers,
  round(sum(CASE WHEN regexp_matches(v, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') THEN TRY_CAST(trim(v) AS DOUBLE) END), 2) AS total
FROM {_CANDIDATES} GROUP BY 1""")
def prepare_number(spark, sf):
    o = table(spark, sf, "orders")
    digit, price = F.substring("o_orderpriority", 1, 1), F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    forms = F.array(F.col("o_orderpriority"), digit, price, F.concat(price, F.lit("d")),
                    F.concat(F.lit(" "), digit, F.lit("e2 ")), F.lit(None).cast("string"))
    v = o.select("o_orderpriority", F.explode(forms).alias("v"))
    x = numbers.as_number(F.col("v"), v.schema["v"].dataType)
    return v.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(x).alias("numbers"), F.round(F.sum(x), 2).alias("total"))


@query("prepare_epoch", """
SELECT unit, day, CAST(count(*) AS BIGINT) AS "rows", min(t) AS first_time, max(t) AS last_time FROM (
  SELECT 'detik' AS unit, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, date_trunc('second', ts) AS t FROM events
  UNION ALL SELECT 'milidetik', CAST(CAST(ts AS DATE) AS VARCHAR), date_trunc('millisecond', ts) FROM events
  UNION ALL SELECT 'mikrodetik', CAST(CAST(ts AS DATE) AS VARCHAR), ts FROM events
  UNION ALL SELECT 'nanodetik', CAST(CAST(ts AS DATE) AS VARCHAR), ts FROM events) u GROUP BY 1, 2""")
def prepare_epoch(spark, sf):
    micros = times.micros_of(F.col("ts"))
    forms = {"detik": F.floor(micros / F.lit(1_000_000)), "milidetik": F.floor(micros / F.lit(1000)), "mikrodetik": micros,
             "nanodetik": micros * 1000}
    items = F.array(*[F.struct(F.lit(u).alias("unit"), times.from_epoch(c.cast("bigint"), u).alias("t"))
                      for u, c in forms.items()])
    e = table(spark, sf, "events").select(F.to_date("ts").cast("string").alias("day"), F.inline(items))
    return e.groupBy("unit", "day").agg(F.count(F.lit(1)).alias("rows"), F.min("t").alias("first_time"),
                                        F.max("t").alias("last_time"))


@query("prepare_zone_and_lag", """
SELECT event_type, CAST(count(*) AS BIGINT) AS "rows", round(avg(lag), 6) AS mean_lag, round(max(lag), 6) AS max_lag FROM (
  SELECT event_type, (epoch_us(ts + to_microseconds(CAST(value * 3600000000 AS BIGINT))) - epoch_us(ts)) / 86400000000.0 AS lag
  FROM events) e GROUP BY 1""")
def prepare_zone_and_lag(spark, sf):
    """The load time carries a zone (an instant); the event time does not."""
    load = F.timestamp_micros(times.micros_of(F.col("ts"))
                              + F.round(F.col("value") * 3_600_000_000).cast("bigint"))
    c = parse_contract("events", {"kunci": {"waktu": "ts", "waktu_muat": "loaded_at"},
                                  "kolom": [{"nama": "ts", "tipe": "datetime"}, {"nama": "loaded_at", "tipe": "datetime"}]})
    e = prepare(table(spark, sf, "events").withColumn("loaded_at", load), c)
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("_lag_days"), 6).alias("mean_lag"),
                                       F.round(F.max("_lag_days"), 6).alias("max_lag"))


@query("prepare_periods", """
SELECT grain, period, CAST(count(*) AS BIGINT) AS "rows", CAST(count(DISTINCT floor_time) AS BIGINT) AS floors,
  round(max(off), 6) AS latest_off FROM (
  SELECT 'jam' AS grain, hour(ts) AS period, date_trunc('hour', ts) AS floor_time,
    (epoch_us(ts) - epoch_us(date_trunc('hour', ts))) / 1e6 AS off FROM events
  UNION ALL SELECT 'hari', day(ts), date_trunc('day', ts), (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6 FROM events
) p GROUP BY 1, 2""")
def prepare_periods(spark, sf):
    out = None
    for grain in ("jam", "hari"):
        c = parse_contract("events", {"kunci": {"waktu": "ts", "granularitas": grain},
                                      "kolom": [{"nama": "ts", "tipe": "datetime"}]})
        p = prepare(table(spark, sf, "events"), c)
        g = p.groupBy(F.lit(grain).alias("grain"), F.col("_period").cast("bigint").alias("period")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("_period_floor").alias("floors"),
            F.round(F.max("_offgrid"), 6).alias("latest_off"))
        out = g if out is None else out.unionByName(g)
    return out


@query("prepare_expected_flags", """
SELECT c_mktsegment AS segment, CAST(count(*) FILTER (WHERE bal IS NOT NULL) AS BIGINT) AS present,
  CAST(count(*) FILTER (WHERE coalesce(bal BETWEEN 0 AND 5000, false)) AS BIGINT) AS present_in_range,
  round(sum(bal), 4) AS total
FROM (SELECT c_mktsegment, CASE WHEN c_acctbal < 9000 THEN c_acctbal END AS bal FROM customer) c GROUP BY 1""")
def prepare_expected_flags(spark, sf):
    c = parse_contract("customer", {
        "kolom": [{"nama": "bal", "tipe": "float", "rentang": [0, 5000], "profil_distribusi": True},
                  {"nama": "has_bal", "tipe": "boolean"}, {"nama": "ok_bal", "tipe": "boolean"}],
        "flag_dq": [{"flag": "has_bal", "kolom": "bal", "aturan": "ada"},
                    {"flag": "ok_bal", "kolom": "bal", "aturan": "ada_dan_dalam_rentang"}]})
    nan = F.when(F.col("c_acctbal") < 9000, F.col("c_acctbal")).otherwise(F.lit(float("nan")))     # NaN counts as missing
    f = prepare(table(spark, sf, "customer").withColumn("bal", nan), c)
    return f.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count_if(expected_column("has_bal")).alias("present"), F.count_if(expected_column("ok_bal")).alias("present_in_range"),
        F.round(F.sum(number_column("bal")), 4).alias("total"))


@query("byte_sizes_as_text", """
SELECT source, CAST(sum(n_chars) AS BIGINT) AS bytes, CASE WHEN sum(n_chars) >= 1e9 THEN printf('%.2f GB', sum(n_chars) / 1e9)
  WHEN sum(n_chars) >= 1e6 THEN printf('%.2f MB', sum(n_chars) / 1e6) WHEN sum(n_chars) >= 1e3 THEN printf('%.2f KB', sum(n_chars) / 1e3)
  ELSE printf('%d B', CAST(sum(n_chars) AS BIGINT)) END AS shown FROM documents GROUP BY 1""")
def byte_sizes_as_text(spark, sf):
    d = table(spark, sf, "documents").groupBy("source").agg(F.sum("n_chars").alias("bytes"))
    return d.withColumn("shown", numbers.bytes_text(F.col("bytes")))
