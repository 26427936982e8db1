"""Contract inference."""

from __future__ import annotations

from itertools import combinations

import pyarrow as pa
from pyspark.sql import functions as F

from lakegauge.operators.prepare import PART, with_partition
from lakegauge.plans import infer
from lakegauge.session import small_table
from lakegauge.suite import query
from lakegauge.suite.common import DAILY_EVENTS, daily_events, table

_PROFILED = {"documents": ["doc_id", "text", "lang", "source", "n_chars"],
             "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]}
_KINDS = {"doc_id": "integer", "n_chars": "integer", "c_custkey": "integer", "c_nationkey": "integer", "c_acctbal": "float"}


@query("profile_columns", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", '{_KINDS.get(c, 'string')}' AS kind, CAST(count(*) AS BIGINT) AS "rows",
  CAST(count(*) - count({c}) AS BIGINT) AS nulls, count(*) = count({c}) AS required, """
    + (f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, -1 AS len_min, -1 AS len_max" if c in _KINDS else
       f"-1.0::DOUBLE AS low, -1.0::DOUBLE AS high, CAST(min(length({c})) AS INTEGER) AS len_min, CAST(max(length({c})) AS INTEGER) AS len_max")
    + f" FROM {t}" for t, cols in _PROFILED.items() for c in cols))
def profile_columns(spark, sf):
    out = None
    for t, cols in _PROFILED.items():
        p = infer.column_profile(table(spark, sf, t).select(*cols)).withColumn("table", F.lit(t))
        out = p if out is None else out.unionByName(p)
    return out.select("table", "column", "kind", "rows", "nulls", "required", F.coalesce("min", F.lit(-1.0)).alias("low"),
                      F.coalesce("max", F.lit(-1.0)).alias("high"), F.coalesce("len_min", F.lit(-1)).alias("len_min"),
                      F.coalesce("len_max", F.lit(-1)).alias("len_max"))


@query("profile_distinct_values", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values FROM lineitem"""
    for c in ("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_orderkey")))
def profile_distinct_values(spark, sf):
    return infer.distinct_values(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_orderkey"])


@query("guess_surrogate_key", f"""
SELECT c AS "column", coalesce(max(n), 0) <= 1 AS unique_per_partition FROM (
  SELECT 'event_id' AS c, day, event_id::VARCHAR AS v, count(*) AS n FROM {DAILY_EVENTS} GROUP BY 1, 2, 3
  UNION ALL SELECT 'user_id', day, user_id::VARCHAR, count(*) FROM {DAILY_EVENTS} GROUP BY 1, 2, 3
  UNION ALL SELECT 'event_type', day, event_type, count(*) FROM {DAILY_EVENTS} GROUP BY 1, 2, 3) x GROUP BY 1""")
def guess_surrogate_key(spark, sf):
    return infer.unique_columns(daily_events(spark, sf), ["event_id", "user_id", "event_type"])


@query("guess_time_columns", """
SELECT 'o_orderdate' AS "column", round(avg(epoch_us(o_orderdate)) / 1e6, 1) AS mean_seconds, true AS is_event, false AS is_load FROM orders JOIN lineitem ON o_orderkey = l_orderkey
UNION ALL SELECT 'l_shipdate', round(avg(epoch_us(l_shipdate)) / 1e6, 1), false, true FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def guess_time_columns(spark, sf):
    """No name gives a hint here: the first time column is the event, the latest on average the load time."""
    j = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    m = infer.time_means(j, ["o_orderdate", "l_shipdate"])
    means = {r["column"]: r["mean_micros"] for r in m.collect()}
    event, load = infer.guess_times(["o_orderdate", "l_shipdate"], means)
    return m.select("column", F.round(F.col("mean_micros") / 1e6, 1).alias("mean_seconds"), (F.col("column") == event).alias("is_event"),
                    (F.col("column") == F.lit(load)).alias("is_load"))


@query("guess_grain", """
SELECT 'orders' AS "table", CAST(count(DISTINCT hour(o_orderdate)) AS BIGINT) AS hours_seen, round(avg(CASE WHEN minute(o_orderdate) = 0 THEN 1.0 ELSE 0 END), 6) AS full_hour_share,
  round(avg(CASE WHEN hour(o_orderdate) = 0 THEN 1.0 ELSE 0 END), 6) AS midnight_share, 'hari' AS grain FROM orders
UNION ALL SELECT 'events', count(DISTINCT hour(ts)), round(avg(CASE WHEN minute(ts) = 0 THEN 1.0 ELSE 0 END), 6), round(avg(CASE WHEN hour(ts) = 0 THEN 1.0 ELSE 0 END), 6), '-' FROM events
UNION ALL SELECT 'hourly', count(DISTINCT hour(ts)), 1.0, round(avg(CASE WHEN hour(ts) = 0 THEN 1.0 ELSE 0 END), 6), 'jam' FROM events""")
def guess_grain(spark, sf):
    e = table(spark, sf, "events")
    hourly = e.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    out = None
    for name, df, c in (("orders", table(spark, sf, "orders"), "o_orderdate"), ("events", e, "ts"), ("hourly", hourly, "ts")):
        g = infer.grain_stats(df, c).withColumn("table", F.lit(name))
        out = g if out is None else out.unionByName(g)
    return out.select("table", "hours_seen", F.round("full_hour_share", 6).alias("full_hour_share"),
                      F.round("midnight_share", 6).alias("midnight_share"), F.coalesce("grain", F.lit("-")).alias("grain"))


@query("guess_business_key", """
SELECT c AS "column", round(count(*) * 1.0 / sum(n), 6) AS score FROM (
  SELECT 'o_orderpriority' AS c, o_orderpriority AS v, o_orderdate AS t, count(*) AS n FROM orders GROUP BY 1, 2, 3
  UNION ALL SELECT 'o_orderstatus', o_orderstatus, o_orderdate, count(*) FROM orders GROUP BY 1, 2, 3) x GROUP BY 1""")
def guess_business_key(spark, sf):
    s = infer.key_scores(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], "o_orderdate")
    return s.select("column", F.round("score", 6).alias("score"))


@query("code_and_measure_columns", """
WITH d AS (SELECT 'p_brand' AS "column", 'string' AS kind, count(DISTINCT p_brand) AS n FROM part UNION ALL SELECT 'p_type', 'string', count(DISTINCT p_type) FROM part
  UNION ALL SELECT 'p_name', 'string', count(DISTINCT p_name) FROM part UNION ALL SELECT 'p_retailprice', 'float', count(DISTINCT p_retailprice) FROM part)
SELECT "column", kind, CAST(n AS BIGINT) AS distinct_values, kind = 'string' AND n BETWEEN 1 AND 200 AS is_code, kind = 'float' AND n > 5 AS is_measure FROM d""")
def code_and_measure_columns(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_type", "p_name", "p_retailprice")
    d = infer.column_profile(p).join(infer.distinct_values(p, p.columns), "column")
    n, kind = F.col("distinct_values"), F.col("kind")
    return d.select("column", "kind", n, ((kind == "string") & n.between(1, infer.MAX_CODES)).alias("is_code"),
                    (kind.isin("float", "decimal") & F.col("max").isNotNull() & (n > 5)).alias("is_measure"))


_FD = [("lang", "source"), ("source", "lang"), ("lang", "region"), ("region", "lang"), ("source", "region"), ("region", "source")]
_FD_TABLE = "(SELECT lang, source, CASE WHEN n_chars > 300 THEN CASE WHEN lang = 'en' THEN 'uk' ELSE 'eu' END END AS region FROM documents) d"


@query("functional_dependencies", " UNION ALL ".join(
    f"""SELECT '{a}' AS left_column, '{b}' AS right_column, CAST(count(*) AS BIGINT) AS left_values, CAST(max(t) AS BIGINT) AS most_targets,
  max(t) = 1 AND count(*) > 1 AS determines FROM (SELECT {a}, count(DISTINCT {b}) AS t FROM {_FD_TABLE} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1) x"""
    for a, b in _FD))
def functional_dependencies(spark, sf):
    d = table(spark, sf, "documents").withColumn(
        "region", F.expr("CASE WHEN n_chars > 300 THEN CASE WHEN lang = 'en' THEN 'uk' ELSE 'eu' END END"))
    return infer.dependencies(d, ["lang", "source", "region"])


_CODES = {"flag": "l_returnflag", "status": "l_linestatus", "flag_status": "concat(l_returnflag, l_linestatus)", "lower_flag": "lower(l_returnflag)",
          "line": "CAST(l_linenumber AS VARCHAR(9))", "year": "CAST(year(l_shipdate) AS VARCHAR(9))",
          "month": "concat(CAST(year(l_shipdate) AS VARCHAR(9)), '-', CAST(month(l_shipdate) AS VARCHAR(9)))",
          "seen_year": "CASE WHEN l_linenumber > 1 THEN CAST(year(l_shipdate) AS VARCHAR(9)) END"}
_CODE_TABLE = "l AS (SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in _CODES.items()) + " FROM lineitem)"


@query("relations_discovered", f"WITH {_CODE_TABLE} " + " UNION ALL ".join(
    f"""SELECT '{a}' AS left_column, '{b}' AS right_column, coalesce(max(t) = 1 AND count(*) > 1, false) AS determines,
  (SELECT count(*) > 0 AND count(*) FILTER (WHERE "{a}" <> "{b}") = 0 FROM l WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL) AS equal
FROM (SELECT "{a}", count(DISTINCT "{b}") AS t FROM l WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL GROUP BY 1) x"""
    for a in _CODES for b in _CODES if a != b))
def relations_discovered(spark, sf):
    """Dependencies and equal columns among all code columns, for every ordered pair."""
    li = table(spark, sf, "lineitem").select(*[F.expr(e).alias(n) for n, e in _CODES.items()])
    found = infer.discover(li, list(_CODES))
    rows = [{"left_column": a, "right_column": b, "determines": d, "equal": (a, b) in found.equal or (b, a) in found.equal}
            for (a, b), d in found.determines.items()]
    return small_table(spark, rows, pa.schema([("left_column", pa.string()), ("right_column", pa.string()), ("determines", pa.bool_()), ("equal", pa.bool_())]))


@query("identical_columns", """
WITH l AS (SELECT l_returnflag AS a, CASE WHEN l_linenumber > 1 THEN l_returnflag END AS b, l_linestatus AS c FROM lineitem)
SELECT 'a' AS left_column, 'b' AS right_column, CAST(count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS BIGINT) AS compared, CAST(count(*) FILTER (WHERE a <> b) AS BIGINT) AS different, true AS equal FROM l
UNION ALL SELECT 'a', 'c', count(*), count(*) FILTER (WHERE a <> c), count(*) FILTER (WHERE a <> c) = 0 FROM l
UNION ALL SELECT 'b', 'c', count(*) FILTER (WHERE b IS NOT NULL), count(*) FILTER (WHERE b <> c), count(*) FILTER (WHERE b <> c) = 0 FROM l""")
def identical_columns(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr("l_returnflag AS a", "CASE WHEN l_linenumber > 1 THEN l_returnflag END AS b", "l_linestatus AS c")
    return infer.equal_columns(li, list(combinations(["a", "b", "c"], 2)))


@query("guess_time_order", """
SELECT CAST(count(*) AS BIGINT) AS compared, min(CASE WHEN l_shipdate >= o_orderdate THEN 1 ELSE 0 END) = 1 AS always FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT count(*), true FROM lineitem""")
def guess_time_order(spark, sf):
    li = table(spark, sf, "lineitem")
    j = li.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    later = li.withColumn("loaded_at", F.col("l_shipdate") + F.expr("INTERVAL 1 DAY"))
    return infer.time_order(j, "l_shipdate", "o_orderdate").unionByName(infer.time_order(later, "loaded_at", "l_shipdate"))


@query("guess_constant_flags", """
SELECT 'positive' AS "column", true AS constant, true AS value FROM lineitem GROUP BY 1
UNION ALL SELECT 'big', count(DISTINCT l_quantity > 25) = 1, min(l_quantity > 25) FROM lineitem""")
def guess_constant_flags(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({"positive": F.expr("l_quantity > 0"), "big": F.expr("l_quantity > 25")})
    return infer.constant_flags(li, ["positive", "big"])


@query("draft_contract", """
SELECT 'doc_id' AS "column", 'integer' AS kind, false AS is_code FROM documents GROUP BY 1 UNION ALL SELECT 'n_chars', 'integer', false FROM documents GROUP BY 1
UNION ALL SELECT 'text', 'string', count(DISTINCT text) BETWEEN 1 AND 200 FROM documents
UNION ALL SELECT 'lang', 'string', count(DISTINCT lang) BETWEEN 1 AND 200 FROM documents
UNION ALL SELECT 'source', 'string', count(DISTINCT source) BETWEEN 1 AND 200 FROM documents""")
def draft_contract(spark, sf):
    """Full inference over documents, one partition per language."""
    d = with_partition(table(spark, sf, "documents"), F.lit(None), F.col("lang"))
    draft = infer.infer(d)
    kinds = {c["column"]: (c["kind"], c["column"] in draft.references) for c in draft.columns}
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(k).alias("kind"), F.lit(c).alias("is_code")) for n, (k, c) in kinds.items()])
    return d.agg(F.count(PART).alias("n")).filter("n > 0").select(F.inline(rows))
