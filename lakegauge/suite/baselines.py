"""Baseline learning: per-partition statistics, corridors, patterns, storage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakegauge.contract import parse_contract
from lakegauge.functions import text
from lakegauge.operators import keys, order_stats
from lakegauge.operators.prepare import PART, PART_DATE, with_partition
from lakegauge.plans import baseline as bl
from lakegauge.plans import patterns
from lakegauge.session import scratch_path
from lakegauge.suite import query
from lakegauge.suite.common import DAILY_EVENTS, daily_events, table

EVENTS = {"sumber": {"partisi": "harian"},
          "kunci": {"surrogate": "event_id", "bisnis": ["user_id", "ts"], "waktu": "ts", "granularitas": "jam"},
          "kolom": [{"nama": "event_id", "tipe": "integer"}, {"nama": "ts", "tipe": "datetime"},
                    {"nama": "user_id", "tipe": "integer"},
                    {"nama": "event_type", "tipe": "string", "referensi": True, "wajib": False},
                    {"nama": "value", "tipe": "float", "rentang": [0.05, 140], "profil_distribusi": True, "wajib": False},
                    {"nama": "props", "tipe": "string", "regex": r'^\{"k": \d+\}$'}]}
HISTORY = f"(SELECT * FROM {DAILY_EVENTS} WHERE day < (SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR) FROM events)) h"


def contract():
    return parse_contract("events", EVENTS)


def history(spark, sf):
    return bl.exclude_partitions(daily_events(spark, sf))[0]


@query("baseline_guard", f"""SELECT day, CAST(count(*) AS BIGINT) AS "rows" FROM {HISTORY} GROUP BY 1""")
def baseline_guard(spark, sf):
    """The newest partition stays out of its own baseline."""
    return history(spark, sf).groupBy(F.col(PART).alias("day")).agg(F.count(F.lit(1)).alias("rows"))


@query("baseline_exclude_named", f"""SELECT day, CAST(count(*) AS BIGINT) AS "rows" FROM {DAILY_EVENTS}
WHERE day NOT IN ('2024-01-03', '2024-01-04') GROUP BY 1""")
def baseline_exclude_named(spark, sf):
    kept, _ = bl.exclude_partitions(daily_events(spark, sf), ["2024-01-03", "2024-01-04"])
    return kept.groupBy(F.col(PART).alias("day")).agg(F.count(F.lit(1)).alias("rows"))


_IN = "CASE WHEN value BETWEEN 0.05 AND 140 THEN value END"


def _sized(column: str, text: bool) -> str:
    low, high = (f"{f}(length({column}))" if text else "-1" for f in ("min", "max"))
    return (f"SELECT day, '{column}', count(*), count(*) - count({column}), {low}, {high}, -1, NULL, NULL, NULL, NULL, -1 "
            f"FROM {HISTORY} GROUP BY 1")


@query("baseline_partition_stats", f"""
SELECT day, 'value' AS "column", CAST(count(*) AS BIGINT) AS "rows", CAST(count(*) - count(value) AS BIGINT) AS nulls, -1::BIGINT AS len_min,
  -1::BIGINT AS len_max, CAST(count({_IN}) AS BIGINT) AS n, round(avg({_IN}), 6) AS mean, round(stddev_pop({_IN}), 6) AS sd,
  min({_IN}) AS low, max({_IN}) AS high, CAST(count(*) FILTER (WHERE {_IN} = 0) AS BIGINT) AS zeros FROM {HISTORY} GROUP BY 1
UNION ALL """ + " UNION ALL ".join(_sized(c, c in ("event_type", "props")) for c in ("event_id", "ts", "user_id", "event_type", "props")))
def baseline_partition_stats(spark, sf):
    s = bl.column_stats(history(spark, sf), contract(), [PART])
    whole = [F.coalesce(F.col(c).cast("bigint"), F.lit(-1)).alias(c) for c in ("len_min", "len_max", "n", "zeros")]
    return s.select(F.col(PART).alias("day"), "column", "rows", "nulls", *whole, F.round("mean", 6).alias("mean"),
                    F.round("sd", 6).alias("sd"), F.col("min").alias("low"), F.col("max").alias("high"))


@query("baseline_volume", f"""
SELECT CAST(min(r) AS BIGINT) AS rows_min, CAST(max(r) AS BIGINT) AS rows_max, CAST(floor(median(r)) AS BIGINT) AS rows_median,
  CAST(count(*) AS BIGINT) AS partitions, CAST(floor(floor(median(r)) * 0.85) AS BIGINT) AS rows_low,
  CAST(floor(floor(median(r)) * 1.15) AS BIGINT) AS rows_high FROM (SELECT day, count(*) AS r FROM {HISTORY} GROUP BY 1) p""")
def baseline_volume(spark, sf):
    rows = history(spark, sf).groupBy(PART).agg(F.count(F.lit(1)).alias("rows"))
    return bl.volume_corridor(rows, 0.15)


@query("baseline_entities_and_periods", f"""
SELECT CAST(min(u) AS BIGINT) AS entities_min, CAST(max(u) AS BIGINT) AS entities_max, CAST(max(p) AS BIGINT) AS periods
FROM (SELECT day, count(DISTINCT user_id) AS u, count(DISTINCT hour(ts)) AS p FROM {HISTORY} GROUP BY 1) x""")
def baseline_entities_and_periods(spark, sf):
    from lakegauge.functions import times
    h = history(spark, sf)
    p = h.groupBy(PART).agg(times.distinct_periods(F.hour("ts")).alias("p"))
    return keys.distinct_count(h, [PART], "user_id").join(p, PART).agg(
        F.min("distinct_count").alias("entities_min"), F.max("distinct_count").alias("entities_max"), F.max("p").alias("periods"))


_RATES = " UNION ALL ".join(f"""SELECT day, '{c}' AS "column", 1.0 - count({c}) * 1.0::DOUBLE / count(*) AS r FROM {HISTORY} GROUP BY 1"""
                           for c in ("event_id", "ts", "user_id", "event_type", "value", "props"))


@query("baseline_null_rates", f"""
SELECT "column", round(min(r), 6) AS null_min, round(max(r), 6) AS null_max, round(avg(r), 6) AS null_mean,
  round_even(greatest(0.0, 1.0 - (max(r) + 0.05)), 4) AS min_present FROM ({_RATES}) x GROUP BY 1""")
def baseline_null_rates(spark, sf):
    n = bl.null_corridor(bl.column_stats(history(spark, sf), contract(), [PART]), 0.05)
    return n.select("column", *[F.round(c, 6).alias(c) for c in ("null_min", "null_max", "null_mean")], "min_present")


@query("baseline_numeric", f"""
WITH p AS (SELECT day, count(v) AS n, avg(v) AS m, stddev_pop(v) AS s, min(v) AS lo, max(v) AS hi FROM (SELECT day, {_IN} AS v FROM {HISTORY}) x GROUP BY 1)
SELECT 'value' AS "column", CAST(sum(n) AS BIGINT) AS n, (SELECT round(avg({_IN}), 6) FROM {HISTORY}) AS mean_global,
  (SELECT round(stddev_pop({_IN}), 6) FROM {HISTORY}) AS sd_global, round(min(m), 6) AS mean_min, round(max(m), 6) AS mean_max,
  round(max(s), 6) AS sd_max, 0.0::DOUBLE AS zero_min, 0.0::DOUBLE AS zero_max, min(lo) AS low, max(hi) AS high FROM p""")
def baseline_numeric(spark, sf):
    s = bl.column_stats(history(spark, sf), contract(), [PART])
    n = bl.numeric_corridor(s)
    return n.select("column", "n", *[F.round(c, 6).alias(c) for c in ("mean_global", "sd_global", "mean_min", "mean_max", "sd_max")],
                    "zero_min", "zero_max", F.col("min").alias("low"), F.col("max").alias("high"))


@query("baseline_quantile_range", f"""
WITH r AS (SELECT day, v, row_number() OVER (PARTITION BY day ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY day) AS n
           FROM (SELECT day, {_IN} AS v FROM {HISTORY}) x WHERE v IS NOT NULL),
q AS (SELECT unnest([0.5, 0.75, 0.95, 0.99])::DOUBLE AS q)
SELECT CAST(q AS VARCHAR) AS q, min(v) AS low, max(v) AS high FROM r, q WHERE i = floor(q * (n - 1)) GROUP BY 1""")
def baseline_quantile_range(spark, sf):
    h = history(spark, sf)
    long = order_stats.long_values(h, [PART], bl.profiled_numbers(h, contract()))
    return order_stats.quantiles(long, [PART], list(bl.QS)).groupBy(F.col("name").alias("q")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"))


@query("baseline_rejects", f"""
SELECT day, 'value' AS "column", value, 0.05::DOUBLE AS low, 140.0::DOUBLE AS high,
  CAST(event_id AS VARCHAR) || '/' || CAST(user_id AS VARCHAR) AS row_key FROM {HISTORY} WHERE value < 0.05 OR value > 140""")
def baseline_rejects(spark, sf):
    r = bl.reject_rows(history(spark, sf), contract())
    key = F.regexp_extract("row_key", r"^(\d+/\d+)", 1)
    return r.select(F.col(PART).alias("day"), "column", "value", "low", "high", key.alias("row_key"))


@query("baseline_text_lengths", """
SELECT 'c_name' AS "column", CAST(count(DISTINCT c_name) AS BIGINT) AS distinct_values, CAST(min(length(c_name)) AS INTEGER) AS len_min,
  CAST(max(length(c_name)) AS INTEGER) AS len_max FROM customer
UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment), min(length(c_mktsegment)), max(length(c_mktsegment)) FROM customer""")
def baseline_text_lengths(spark, sf):
    from lakegauge.plans import infer
    c = table(spark, sf, "customer").select("c_name", "c_mktsegment")
    return infer.distinct_values(c, c.columns).join(infer.column_profile(c).select("column", "len_min", "len_max"), "column")


_ALNUM = r"\p{Lu}\p{Ll}\p{Nd}"


@query("text_shapes", r"""
WITH v AS (SELECT 'c_name' AS "column", c_name AS v FROM customer UNION ALL SELECT 's_name', s_name FROM supplier
  UNION ALL SELECT 'p_brand', p_brand FROM part UNION ALL SELECT 'p_name', p_name FROM part
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders)
SELECT "column", regexp_replace(regexp_replace(regexp_replace(v, '[a-z]+', '<l>', 'g'), '[A-Z]+', '<u>', 'g'), '[0-9]+', '{D}', 'g')
  .replace('<l>', '{L}').replace('<u>', '{U}') AS shape, CAST(count(*) AS BIGINT) AS "rows" FROM v GROUP BY 1, 2""")
def text_shapes(spark, sf):
    out = None
    for t, c in (("customer", "c_name"), ("supplier", "s_name"), ("part", "p_brand"), ("part", "p_name"), ("orders", "o_orderpriority")):
        s = patterns.column_shapes(patterns.long_text(table(spark, sf, t), [c]))
        out = s if out is None else out.unionByName(s)
    return out.select("column", text.readable_shape(F.col("shape")).alias("shape"), "rows")


@query("text_shape_lengths", r"""
WITH s AS (SELECT 'p_brand' AS "column", 1 AS pos, length(regexp_extract(p_brand, '^([A-Z])', 1)) AS n FROM part
  UNION ALL SELECT 'p_brand', 2, length(regexp_extract(p_brand, '([a-z]+)', 1)) FROM part
  UNION ALL SELECT 'p_brand', 3, 1 FROM part UNION ALL SELECT 'p_brand', 4, length(regexp_extract(p_brand, '([0-9]+)', 1)) FROM part)
SELECT "column", CAST(pos - 1 AS INTEGER) AS pos, CAST(min(n) AS INTEGER) AS lo, CAST(max(n) AS INTEGER) AS hi FROM s GROUP BY 1, 2""")
def text_shape_lengths(spark, sf):
    return patterns.shape_positions(patterns.long_text(table(spark, sf, "part"), ["p_brand"])).drop("shape")


@query("text_characters", r"""
WITH v AS (SELECT 'url' AS "column", url AS v FROM pages UNION ALL SELECT 'text', text FROM documents)
SELECT DISTINCT "column", ch FROM (SELECT "column", unnest(regexp_extract_all(v, '(?s)[^A-Za-z0-9]')) AS ch FROM v) x""")
def text_characters(spark, sf):
    return patterns.other_characters(patterns.long_text(table(spark, sf, "pages"), ["url"]).unionByName(
        patterns.long_text(table(spark, sf, "documents"), ["text"])))


@query("text_patterns_hold", """
SELECT 'c_name' AS "column", CAST(count(*) AS BIGINT) AS values_tested, 0::BIGINT AS unmatched FROM customer
UNION ALL SELECT 'p_brand', count(*), 0 FROM part UNION ALL SELECT 'url', count(*), 0 FROM pages UNION ALL SELECT 'text', count(*), 0 FROM documents
UNION ALL SELECT 'props', count(*), 0 FROM events""")
def text_patterns_hold(spark, sf):
    """Derived patterns cover every value they came from; free text falls back to a general pattern."""
    out = None
    for t, c in (("customer", "c_name"), ("part", "p_brand"), ("pages", "url"), ("documents", "text"), ("events", "props")):
        df = table(spark, sf, t)
        found = patterns.derive(df, [c])[c]
        r = df.agg(F.lit(c).alias("column"), F.count(c).alias("values_tested"),
                   F.count_if(~text.finds_any(F.col(c), found)).alias("unmatched"))
        out = r if out is None else out.unionByName(r)
    return out


@query("baseline_store_and_load", f"""
SELECT day, CAST(count(*) AS BIGINT) AS "rows", CAST((SELECT count(DISTINCT event_type) FROM {HISTORY}) AS BIGINT) AS known_codes,
  (SELECT min(value) FROM {HISTORY} WHERE value BETWEEN 0.05 AND 140) AS low FROM {HISTORY} GROUP BY 1""")
def baseline_store_and_load(spark, sf):
    root = scratch_path(spark, "baselines")
    b = bl.learn(daily_events(spark, sf), contract(), now=dt.datetime(2024, 2, 1))
    bl.save(b, root, spark)
    b = bl.load(spark, root, "events")
    return b.partitions.select(F.col(PART).alias("day"), "rows", F.lit(b.master_sizes["event_type"]).cast("bigint").alias("known_codes"),
                               F.lit(b.distribution["value"]["min"]).alias("low"))


@query("baseline_to_build", """SELECT 'orders' AS dataset, CAST(count(*) AS BIGINT) AS "rows" FROM orders""")
def baseline_to_build(spark, sf):
    """With rebuilding off, only datasets without a stored baseline are left to build."""
    root = scratch_path(spark, "baselines")
    bl.save(bl.learn(daily_events(spark, sf), contract(), now=dt.datetime(2024, 2, 1)), root, spark)
    out = None
    for name in bl.to_build(spark, root, ["events", "orders"], rebuild=False):
        n = table(spark, sf, name).agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"))
        out = n if out is None else out.unionByName(n)
    return out


@query("baseline_incremental", f"""
WITH h AS (SELECT day, {_IN} AS v, event_type FROM {HISTORY}),
r AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM h WHERE v IS NOT NULL)
SELECT 'value' AS "column", (SELECT CAST(count(*) AS BIGINT) FROM h) AS "rows", (SELECT CAST(count(DISTINCT day) AS BIGINT) FROM h) AS partitions,
  1::BIGINT AS days_read, true AS equals_full, (SELECT min(v) FROM r WHERE i = floor(0.5::DOUBLE * (n - 1))) AS median,
  (SELECT min(v) FROM r WHERE i = floor(0.99::DOUBLE * (n - 1))) AS p99, (SELECT CAST(count(DISTINCT event_type) AS BIGINT) FROM h) AS types""")
def baseline_incremental(spark, sf):
    """A baseline after one more day: only that day is read, and it equals one learned from all days at once."""
    store, e, c, now = scratch_path(spark, "states"), daily_events(spark, sf), contract(), dt.datetime(2024, 2, 1)
    days, seen = e.groupBy(F.col(PART).alias("part"), F.col(PART_DATE).alias("part_date")).agg(F.xxhash64(F.count("*")).alias("fingerprint")), []

    def read(new):
        seen.append(new.count())
        return e.join(new.withColumnRenamed("part", PART), PART, "left_semi")

    last = days.agg(F.max("part")).first()[0]
    bl.relearn(spark, c, store, days.filter(F.col("part") != last), read, exclude=["none"], now=now)
    b = bl.relearn(spark, c, store, days, read, exclude=["none"], now=now)
    full = bl.learn(e, c, exclude=["none"], now=now)
    same = all(getattr(b, k) == getattr(full, k) for k in bl.Baseline.SCALARS if k not in ("text", "distribution")) and all(
        _close(getattr(b, k), getattr(full, k)) for k in ("text", "distribution"))
    b = bl.relearn(spark, c, store, days, read, now=now)                   # all is remembered; the newest day is left out
    v = b.distribution["value"]
    return b.partitions.agg(F.lit("value").alias("column"), F.sum("rows").alias("rows"), F.count("*").alias("partitions")).withColumns({
        "days_read": F.lit(sum(seen[1:])).cast("bigint"), "equals_full": F.lit(same), "median": F.lit(v["quantiles"]["0.5"]),
        "p99": F.lit(v["quantiles"]["0.99"]), "types": F.lit(b.text["event_type"]["distinct_values"]).cast("bigint")})


def _close(a, b):
    """Equal but for the last digits of sums that were added up in another order."""
    if isinstance(a, dict):
        return a.keys() == b.keys() and all(_close(a[k], b[k]) for k in a)
    if isinstance(a, (list, tuple)):
        return len(a) == len(b) and all(map(_close, a, b))
    return abs(a - b) <= 1e-9 * max(1.0, abs(a)) if isinstance(a, float) else a == b


__all__ = ["EVENTS", "HISTORY", "PART_DATE", "contract", "history", "with_partition"]
