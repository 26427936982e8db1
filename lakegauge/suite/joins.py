"""Membership, reconciliation and schema comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakegauge.contract import parse_contract
from lakegauge.operators import membership, onepass, reconcile, schema
from lakegauge.operators.prepare import PART, with_partition
from lakegauge.session import materialise
from lakegauge.sources import external
from lakegauge.suite import query
from lakegauge.suite.common import DAILY_EVENTS, daily_events, table

DAY = "CAST(CAST(ts AS DATE) AS VARCHAR)"


@query("in_master_list", f"""
WITH h AS (SELECT DISTINCT event_type AS code FROM {DAILY_EVENTS} WHERE event_type IS NOT NULL AND event_type <> 'signup')
SELECT day, 'event_type' AS "column", CAST(count(*) AS BIGINT) AS element_count,
  CAST(count(*) FILTER (WHERE event_type IS NULL) AS BIGINT) AS missing_count,
  CAST(count(*) FILTER (WHERE event_type IS NOT NULL AND code IS NULL) AS BIGINT) AS unexpected_count,
  count(*) FILTER (WHERE event_type IS NOT NULL AND code IS NULL) = 0 AS success
FROM {DAILY_EVENTS} LEFT JOIN h ON event_type = code GROUP BY 1""")
def in_master_list(spark, sf):
    e = daily_events(spark, sf)
    master = membership.code_list(e, ["event_type"]).filter("code <> 'signup'")
    r = membership.against_master(membership.value_counts(e, [PART], ["event_type"]), [PART], master)
    return r.select(F.col(PART).alias("day"), "column", "element_count", "missing_count", "unexpected_count", "success")


@query("in_master_list_of_numbers", """
WITH h AS (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 1)
SELECT l_returnflag AS flag, 'l_suppkey' AS "column", CAST(count(*) AS BIGINT) AS element_count,
  CAST(count(*) FILTER (WHERE h.l_suppkey IS NULL) AS BIGINT) AS unexpected_count
FROM lineitem l LEFT JOIN h ON l.l_suppkey = h.l_suppkey GROUP BY 1""")
def in_master_list_of_numbers(spark, sf):
    """A whole-number reference column: codes and values are both compared as text."""
    li = table(spark, sf, "lineitem")
    master = membership.code_list(li.filter("l_returnflag = 'A' AND l_linenumber = 1"), ["l_suppkey"])
    r = membership.against_master(membership.value_counts(li, ["l_returnflag"], ["l_suppkey"]), ["l_returnflag"], master)
    return r.select(F.col("l_returnflag").alias("flag"), "column", "element_count", "unexpected_count")


_DOCS = "(SELECT lang, CASE WHEN n_chars > 300 THEN source END AS source, CASE WHEN n_chars > 200 THEN lang END AS l FROM documents)"


@query("pair_in_mapping", f"""
WITH m AS (SELECT DISTINCT source, l FROM {_DOCS} WHERE source IS NOT NULL AND l IS NOT NULL AND NOT (source = 'src3' AND l = 'en'))
SELECT d.lang AS slice, 'source->l' AS relation, CAST(count(*) AS BIGINT) AS element_count,
  CAST(count(*) FILTER (WHERE d.source IS NULL AND d.l IS NULL) AS BIGINT) AS missing_count,
  CAST(count(*) FILTER (WHERE (d.source IS NOT NULL OR d.l IS NOT NULL) AND m.l IS NULL) AS BIGINT) AS unexpected_count
FROM {_DOCS} d LEFT JOIN m ON d.source = m.source AND d.l = m.l GROUP BY 1""")
def pair_in_mapping(spark, sf):
    d = table(spark, sf, "documents").select("lang", F.expr("CASE WHEN n_chars > 300 THEN source END").alias("source"),
                                             F.expr("CASE WHEN n_chars > 200 THEN lang END").alias("l"))
    mapping = membership.relation_map(d, [("source", "l")]).filter("NOT (a = 'src3' AND b = 'en')")
    r = membership.pairs_against(membership.pair_counts(d, ["lang"], [("source", "l")]), ["lang"], mapping)
    return r.select(F.col("lang").alias("slice"), "relation", "element_count", "missing_count", "unexpected_count")


@query("referential_integrity", """
SELECT 'o_custkey' AS "column", o_orderpriority AS slice, CAST(count(*) AS BIGINT) AS element_count,
  CAST(count(*) FILTER (WHERE c_custkey IS NULL) AS BIGINT) AS unexpected_count
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o_custkey = c_custkey GROUP BY 2
UNION ALL SELECT 'l_orderkey', l_returnflag, count(*), count(*) FILTER (WHERE o_orderkey IS NULL)
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 2""")
def referential_integrity(spark, sf):
    """Against a real master table: thinned customers (orphans appear) and orders (none)."""
    c = table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'")
    a = membership.referential(table(spark, sf, "orders"), ["o_orderpriority"], "o_custkey", c, "c_custkey")
    b = membership.referential(table(spark, sf, "lineitem"), ["l_returnflag"], "l_orderkey", table(spark, sf, "orders"), "o_orderkey")
    cols = ["column", "slice", "element_count", "unexpected_count"]
    return a.withColumnRenamed("o_orderpriority", "slice").select(*cols).unionByName(
        b.withColumnRenamed("l_returnflag", "slice").select(*cols))


@query("label_coverage", """
SELECT lang, CAST(count(*) AS BIGINT) AS documents, CAST(count(l.doc_id) AS BIGINT) AS labelled,
  round(count(l.doc_id) * 1.0 / count(*), 6) AS share FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY 1""")
def label_coverage(spark, sf):
    r = membership.referential(table(spark, sf, "documents"), ["lang"], "doc_id", table(spark, sf, "labels"), "doc_id")
    hit = F.col("element_count") - F.col("unexpected_count")
    return r.select("lang", F.col("element_count").alias("documents"), hit.alias("labelled"),
                    F.round(hit / F.col("element_count"), 6).alias("share"))


@query("set_equals_master", f"""
WITH m AS (SELECT DISTINCT event_type AS code FROM events WHERE event_type <> 'view'),
v AS (SELECT DISTINCT day, event_type AS code FROM {DAILY_EVENTS} WHERE event_type IS NOT NULL)
SELECT day, CAST(count(m.code) AS BIGINT) AS known_values, CAST(count(*) FILTER (WHERE m.code IS NULL) AS BIGINT) AS unknown_values,
  CAST((SELECT count(*) FROM m) AS BIGINT) AS master_values,
  count(*) FILTER (WHERE m.code IS NULL) = 0 AND count(m.code) = (SELECT count(*) FROM m) AS success
FROM v LEFT JOIN m ON v.code = m.code GROUP BY 1""")
def set_equals_master(spark, sf):
    master = membership.code_list(table(spark, sf, "events"), ["event_type"]).filter("code <> 'view'")
    r = membership.same_set(membership.value_counts(daily_events(spark, sf), [PART], ["event_type"]), [PART], master)
    return r.select(F.col(PART).alias("day"), "known_values", "unknown_values", "master_values", "success")


@query("master_codes", """
SELECT DISTINCT 'o_orderstatus' AS "column", o_orderstatus AS code FROM orders
UNION SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders""")
def master_codes(spark, sf):
    return membership.code_list(table(spark, sf, "orders"), ["o_orderstatus", "o_custkey"])


@query("sorted_code_lists", """
SELECT DISTINCT 'p_type' AS "column", p_type AS code FROM part UNION SELECT 'p_brand', p_brand FROM part ORDER BY 1, 2""")
def sorted_code_lists(spark, sf):
    """A global sort over range partitions; no list is gathered into one row."""
    return membership.code_list(table(spark, sf, "part"), ["p_type", "p_brand"]).orderBy("column", "code")


@query("relation_map", """
SELECT DISTINCT 'p_brand->p_type' AS relation, p_brand AS a, p_type AS b FROM part
UNION SELECT 'n_name->n_regionkey', n_name, CAST(n_regionkey AS VARCHAR) FROM nation""")
def relation_map(spark, sf):
    return membership.relation_map(table(spark, sf, "part"), [("p_brand", "p_type")]).unionByName(
        membership.relation_map(table(spark, sf, "nation"), [("n_name", "n_regionkey")]))


@query("relation_violations", """
SELECT 'source->lang' AS relation, source AS a, CAST(count(DISTINCT lang) AS BIGINT) AS targets FROM documents GROUP BY 2 HAVING count(DISTINCT lang) > 1
UNION ALL SELECT 'o_custkey->o_orderpriority', CAST(o_custkey AS VARCHAR), count(DISTINCT o_orderpriority) FROM orders GROUP BY 2
HAVING count(DISTINCT o_orderpriority) > 1""")
def relation_violations(spark, sf):
    return membership.relation_violations(membership.relation_map(table(spark, sf, "documents"), [("source", "lang")])).unionByName(
        membership.relation_violations(membership.relation_map(table(spark, sf, "orders"), [("o_custkey", "o_orderpriority")])))


# a landed copy that lost part of one day and doubled part of another
_LANDED = """(SELECT * FROM events WHERE NOT (CAST(ts AS DATE) = DATE '2024-01-10' AND event_type = 'view')
  UNION ALL SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20' AND user_id < 5
  ) l"""


def _landed(spark, sf):
    e = table(spark, sf, "events")
    kept = e.filter("NOT (to_date(ts) = DATE '2024-01-10' AND event_type = 'view')")
    return kept.unionByName(e.filter("to_date(ts) = DATE '2024-01-20' AND user_id < 5"))


_COUNTS = f"""SELECT coalesce(l.day, s.day) AS day, coalesce(landed_rows, 0) AS landed_rows, coalesce(source_rows, 0) AS source_rows
FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS landed_rows FROM {_LANDED} GROUP BY 1) l
FULL JOIN (SELECT CAST(ts - INTERVAL {{h}} HOUR AS DATE) AS day, count(*) AS source_rows FROM events GROUP BY 1) s ON l.day = s.day"""


@query("reconcile_row_counts", f"""
SELECT CAST(day AS VARCHAR) AS day, CAST(landed_rows AS BIGINT) AS landed_rows, CAST(source_rows AS BIGINT) AS source_rows,
  landed_rows = source_rows AS success FROM ({_COUNTS.format(h=0)})""")
def reconcile_row_counts(spark, sf):
    r = reconcile.reconcile_counts(_landed(spark, sf), table(spark, sf, "events"), F.to_date("ts"), reconcile.source_day(F.col("ts")))
    return r.withColumn("day", F.col("day").cast("string"))


@query("reconcile_row_counts_tolerant", f"""
SELECT CAST(day AS VARCHAR) AS day, CAST(landed_rows AS BIGINT) AS landed_rows, CAST(source_rows AS BIGINT) AS source_rows,
  CAST(abs(landed_rows - source_rows) AS BIGINT) AS difference, abs(landed_rows - source_rows) <= 0.05 * source_rows AS success
FROM ({_COUNTS.format(h=7)})""")
def reconcile_row_counts_tolerant(spark, sf):
    """Source windows run from seven to seven."""
    r = reconcile.reconcile_counts(_landed(spark, sf), table(spark, sf, "events"), F.to_date("ts"), reconcile.source_day(F.col("ts"), 7))
    return reconcile.within_tolerance(r, 0.05).withColumn("day", F.col("day").cast("string"))


@query("source_window_count", """
SELECT CAST(count(*) AS BIGINT) AS source_rows FROM events WHERE ts >= TIMESTAMP '2024-01-12 07:00:00' AND ts < TIMESTAMP '2024-01-13 07:00:00'
UNION ALL SELECT count(*) FROM events""")
def source_window_count(spark, sf):
    import datetime as dt
    e = table(spark, sf, "events")
    return external.window_count(e, "ts", dt.date(2024, 1, 12), 7).unionByName(external.window_count(e))


@query("reconcile_rows", """
WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
l AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
      FROM orders WHERE o_orderpriority <> '5-LOW'
      UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH')
SELECT CASE WHEN l.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra'
  WHEN s.o_orderstatus = l.o_orderstatus AND s.o_custkey = l.o_custkey AND s.o_totalprice = l.o_totalprice THEN 'match' ELSE 'changed' END AS status,
  CAST(count(*) AS BIGINT) AS keys FROM s FULL JOIN l ON s.o_orderkey = l.o_orderkey GROUP BY 1""")
def reconcile_rows(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    changed = o.filter("o_orderpriority <> '5-LOW'").withColumn(
        "o_orderstatus", F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END"))
    extra = o.filter("o_orderpriority = '2-HIGH'").withColumn("o_orderkey", F.expr("-1 - o_orderkey"))
    landed = changed.unionByName(extra)
    r = reconcile.reconcile_rows(o, landed, ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"])
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("keys"))


@query("reconcile_rows_drifted", """
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'changed' ELSE 'match' END AS status, CAST(count(*) AS BIGINT) AS keys
FROM orders GROUP BY 1""")
def reconcile_rows_drifted(spark, sf):
    """A number that landed as text: equal where it still reads as the number, changed where it does not or is null."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    landed = o.withColumn("o_custkey", F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN 'n/a' WHEN '2-HIGH' THEN NULL ELSE CAST(o_custkey AS STRING) END"))
    r = reconcile.reconcile_rows(o, landed, ["o_orderkey"], ["o_custkey", "o_orderstatus"])
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("keys"))


@query("reconcile_repeated_keys", """
WITH s AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
l AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2)
SELECT CASE WHEN l.n IS NULL THEN 'missing' WHEN l.n = s.n THEN 'match' ELSE 'changed' END AS status,
  CAST(count(*) AS BIGINT) AS keys FROM s LEFT JOIN l ON s.l_orderkey = l.l_orderkey AND s.l_linenumber = l.l_linenumber GROUP BY 1""")
def reconcile_repeated_keys(spark, sf):
    li = table(spark, sf, "lineitem")
    r = reconcile.reconcile_rows(li, li.filter("l_returnflag <> 'A'"), ["l_orderkey", "l_linenumber"])
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("keys"))


_DRIFT = "o_orderkey % 1009 = 7"


@query("reconcile_rows_differences", f"""
SELECT o_orderkey, CAST(1 AS BIGINT) AS source_rows, CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS BIGINT) AS landed_rows,
  CASE WHEN o_orderstatus = 'F' THEN 'missing' ELSE 'changed' END AS status FROM orders WHERE {_DRIFT}
UNION ALL SELECT -o_orderkey, 0, 1, 'extra' FROM orders WHERE o_orderkey % 5003 = 11""")
def reconcile_rows_differences(spark, sf):
    """Only keys that do not match, found by descending a digest tree to ranges of a few rows."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    landed = o.filter(f"NOT ({_DRIFT} AND o_orderstatus = 'F')").withColumn(
        "o_totalprice", F.expr(f"o_totalprice + CASE WHEN {_DRIFT} THEN 1 ELSE 0 END"))
    extra = o.filter("o_orderkey % 5003 = 11").withColumn("o_orderkey", F.expr("-o_orderkey"))
    return reconcile.digest_tree(o, landed.unionByName(extra), ["o_orderkey"], ranges=64, range_rows=16).differences()


def _present(names, df):
    """Add how many rows of the table hold a value in each named column; none where it has no such column."""
    have = df.columns
    held = df.agg(*[F.count(c).alias(c) for c in have]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("present")) for c in have])))
    return names.join(held, "column", "left").withColumn("present", F.coalesce("present", F.lit(0)))


@query("source_columns_landed", """
SELECT column_name AS "column", (SELECT count(*) FROM orders) AS present FROM information_schema.columns
WHERE table_name = 'orders' AND column_name IN ('o_totalprice', 'o_orderdate')""")
def source_columns_landed(spark, sf):
    o = table(spark, sf, "orders")
    return _present(reconcile.missing_columns(o, o.drop("o_totalprice", "o_orderdate").withColumn("loaded_at", F.lit(None))), o)


@query("source_columns_common", """
SELECT column_name AS "column", (SELECT count(*) FROM orders) AS present FROM information_schema.columns
WHERE table_name = 'orders' AND column_name <> 'o_totalprice'""")
def source_columns_common(spark, sf):
    o = table(spark, sf, "orders")
    return _present(reconcile.common_columns(o, o.drop("o_totalprice").withColumn("loaded_at", F.lit(None))), o)


@query("source_schema_info", """
SELECT column_name AS "column", CAST(ordinal_position AS BIGINT) AS ordinal, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS data_type, is_nullable = 'YES' AS nullable,
  (SELECT count(*) FROM lineitem) AS present FROM information_schema.columns WHERE table_name = 'lineitem'""")
def source_schema_info(spark, sf):
    li = table(spark, sf, "lineitem")
    return _present(external.schema_info(li).drop("max_length"), li)


@query("source_sample")
def source_sample(spark, sf):
    return external.sample_rows(table(spark, sf, "orders"), 1000)


_SAMPLED = ("orders", "customer", "events")


@query("source_sample_holds", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", CAST(least(1000, count(*)) AS BIGINT) AS sampled, true AS all_known FROM {t} HAVING count(*) > 0"""
    for t in _SAMPLED))
def source_sample_holds(spark, sf):
    """A sample of each source has as many rows as asked for, and all of them are rows of the source."""
    out = None
    for name in _SAMPLED:
        source = table(spark, sf, name)
        sample = materialise(external.sample_rows(source, 1000), "sample")
        once = sample.distinct()
        met = source.join(once, [source[c].eqNullSafe(once[c]) for c in source.columns], "left_semi").distinct()
        marks = [d.select(F.lit(name).alias("table"), *[F.lit(int(j == i)).alias(k) for j, k in enumerate(("s", "o", "m"))])
                 for i, d in enumerate((sample, once, met))]
        for m in marks:
            out = m if out is None else out.unionByName(m)
    n = out.groupBy("table").agg(F.sum("s").alias("sampled"), F.sum("o").alias("o"), F.sum("m").alias("m"))
    return n.select("table", "sampled", (F.col("o") == F.col("m")).alias("all_known"))


_EVENTS_CONTRACT = {"kolom": [
    {"nama": "event_id", "tipe": "integer"}, {"nama": "ts", "tipe": "datetime"}, {"nama": "user_id", "tipe": "string"},
    {"nama": "event_type", "tipe": "string"}, {"nama": "value", "tipe": "float"}, {"nama": "gone", "tipe": "decimal"}]}


@query("schema_against_contract", """
WITH c(name, expected) AS (VALUES ('event_id', 'integer'), ('ts', 'datetime'), ('user_id', 'string'), ('event_type', 'string'),
  ('value', 'float'), ('gone', 'decimal')),
a AS (SELECT column_name AS name, CASE data_type WHEN 'BIGINT' THEN 'integer' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'float'
      ELSE 'datetime' END AS actual FROM information_schema.columns WHERE table_name = 'events')
SELECT coalesce(c.name, a.name) AS "column", expected, actual, CASE WHEN a.name IS NULL THEN 'missing' WHEN c.name IS NULL THEN 'unexpected'
  WHEN expected <> actual THEN 'drift' ELSE 'ok' END AS status,
  CASE WHEN a.name IS NULL THEN 0 ELSE (SELECT count(*) FROM events) END AS present FROM c FULL JOIN a ON c.name = a.name""")
def schema_against_contract(spark, sf):
    e = table(spark, sf, "events")
    return _present(schema.schema_diff(e, parse_contract("events", _EVENTS_CONTRACT)), e)


@query("audit_columns_present", """
SELECT name AS "column", CASE WHEN name = 'o_orderdate' THEN (SELECT count(*) FROM orders) ELSE 0 END AS present,
  name = 'o_orderdate' AS success FROM (VALUES ('o_orderdate'), ('filed_at'), ('filed_by')) v(name)""")
def audit_columns_present(spark, sf):
    """Audit columns that must be in the file and filled, whatever the contract lists."""
    o, audit = table(spark, sf, "orders"), ["o_orderdate", "filed_at", "filed_by"]
    lost = schema.missing_audit_columns(o, audit).withColumn("success", F.lit(False))
    kept = reconcile.common_columns(o, o.select(*[a for a in audit if a in o.columns])).withColumn("success", F.lit(True))
    return _present(lost.unionByName(kept), o)


@query("metrics_in_corridor", f"""
WITH m AS (SELECT {DAY} AS day, event_type, avg(value) AS mean, count(*) AS n FROM events GROUP BY 1, 2),
b AS (SELECT event_type, min(mean) AS lo, max(mean) AS hi FROM m WHERE day < '2024-01-21' GROUP BY 1)
SELECT day, m.event_type, round(mean, 6) AS mean, mean BETWEEN lo AND hi AS success FROM m JOIN b ON m.event_type = b.event_type""")
def metrics_in_corridor(spark, sf):
    """Observed metrics joined to a learned corridor table."""
    e = with_partition(table(spark, sf, "events"), F.to_date("ts"))
    m = onepass.grouped_metrics(e, [PART, "event_type"], {"mean": F.avg("value")})
    b = m.filter(F.col(PART) < "2024-01-21").groupBy("event_type").agg(F.min("mean").alias("lo"), F.max("mean").alias("hi"))
    return m.join(b, "event_type").select(F.col(PART).alias("day"), "event_type", F.round("mean", 6).alias("mean"),
                                          F.col("mean").between(F.col("lo"), F.col("hi")).alias("success"))
