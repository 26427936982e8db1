"""Row rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakegauge.contract import ColumnContract, parse_contract
from lakegauge.functions import text
from lakegauge.operators import distribution, onepass, rules
from lakegauge.operators.prepare import with_partition
from lakegauge.plans import baseline as bl
from lakegauge.plans.evaluate import evaluate
from lakegauge.suite import query
from lakegauge.suite.common import DAILY_EVENTS, PART, PART_DATE, daily_events, rule_sql, rule_table, table

NOW = "2024-01-29 12:00:00"


@query("rule_not_null", rule_sql(DAILY_EVENTS, "day", [
    ("not_null:event_type", "true", "event_type IS NULL"), ("not_null:value", "true", "value IS NULL"),
    ("not_null:event_id", "true", "event_id IS NULL")]))
def rule_not_null(spark, sf):
    return rule_table(daily_events(spark, sf), [rules.not_null(f"not_null:{c}", c) for c in ("event_type", "value", "event_id")])


@query("rule_not_empty_text", rule_sql(
    "(SELECT lang, source, CASE WHEN n_chars < 500 THEN '' ELSE text END AS text FROM documents) d", "lang", [
        ("not_empty:text", "text IS NOT NULL", "length(text) < 1"),
        ("not_empty:source", "source IS NOT NULL", "length(source) < 1")], "lang"))
def rule_not_empty_text(spark, sf):
    d = table(spark, sf, "documents").withColumn("text", F.expr("CASE WHEN n_chars < 500 THEN '' ELSE text END"))
    return rule_table(d, [rules.length_between("not_empty:text", "text", 1),
                          rules.length_between("not_empty:source", "source", 1)], "lang", "lang")


@query("rule_audit_not_null", rule_sql("(SELECT o_orderpriority, nullif(o_orderstatus, 'P') AS loaded_by FROM orders) o",
                                       "o_orderpriority", [("audit:loaded_by", "true", "loaded_by IS NULL")], "priority"))
def rule_audit_not_null(spark, sf):
    o = table(spark, sf, "orders").withColumn("loaded_by", F.expr("nullif(o_orderstatus, 'P')"))
    return rule_table(o, [rules.not_null("audit:loaded_by", "loaded_by")], "o_orderpriority", "priority")


# partitions of a 07:00 to 07:00 extract: the plain calendar window fails, the shifted one holds
_SHIFTED = "(SELECT ts, CAST(ts - INTERVAL 7 HOUR AS DATE) AS day FROM events) e"


@query("rule_in_window", rule_sql(_SHIFTED, "day", [
    ("window:calendar", "ts IS NOT NULL",
     "ts < day OR ts > CAST(day AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND"),
    ("window:from_seven", "ts IS NOT NULL",
     "ts < CAST(day AS TIMESTAMP) + INTERVAL 7 HOUR OR ts > CAST(day AS TIMESTAMP) + INTERVAL 31 HOUR - INTERVAL 1 MICROSECOND")]))
def rule_in_window(spark, sf):
    e = with_partition(table(spark, sf, "events"), F.expr("to_date(ts - INTERVAL 7 HOURS)"))
    return rule_table(e, [rules.in_window("window:calendar", "ts", F.col(PART_DATE)),
                          rules.in_window("window:from_seven", "ts", F.col(PART_DATE), offset_hours=7)], PART_DATE)


@query("rule_not_future", rule_sql(DAILY_EVENTS, "day", [("not_future:ts", "ts IS NOT NULL", f"ts > TIMESTAMP '{NOW}'")]))
def rule_not_future(spark, sf):
    return rule_table(daily_events(spark, sf), [
        rules.between("not_future:ts", "ts", hi=F.lit(NOW).cast("timestamp_ntz"))])


@query("rule_on_grid", rule_sql("(SELECT CASE WHEN event_type = 'click' THEN date_trunc('hour', ts) ELSE ts END AS ts, "
                                "CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events) e", "day", [
    ("grid:hour", "ts IS NOT NULL", "ts <> date_trunc('hour', ts)"),
    ("grid:day", "ts IS NOT NULL", "ts <> date_trunc('day', ts)")]))
def rule_on_grid(spark, sf):
    e = table(spark, sf, "events")
    e = e.withColumn("ts", F.when(F.col("event_type") == "click", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
                     .otherwise(F.col("ts")))
    return rule_table(with_partition(e, F.to_date("ts")), [rules.off_grid("grid:hour", "ts", "jam"),
                                                           rules.off_grid("grid:day", "ts", "hari")])


@query("rule_ingest_lag", rule_sql(
    "(SELECT l_returnflag, o_orderdate, l_shipdate, (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0 AS lag "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey) j", "l_returnflag", [
        ("lag:2", "lag IS NOT NULL", "lag < 0 OR lag > 2"), ("lag:260", "lag IS NOT NULL", "lag < 0 OR lag > 260")], "flag"))
def rule_ingest_lag(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rule_table(j, [rules.lag_within("lag:2", "o_orderdate", "l_shipdate", 2),
                          rules.lag_within("lag:260", "o_orderdate", "l_shipdate", 260)], "l_returnflag", "flag")


@query("rule_physical_range", rule_sql("customer", "c_mktsegment", [
    ("range:c_acctbal", "c_acctbal IS NOT NULL", "c_acctbal < 0 OR c_acctbal > 10000"),
    ("range:open_low", "c_acctbal IS NOT NULL", "c_acctbal > 9000")], "segment"))
def rule_physical_range(spark, sf):
    return rule_table(table(spark, sf, "customer"), [rules.between("range:c_acctbal", "c_acctbal", 0, 10000),
                                                     rules.between("range:open_low", "c_acctbal", hi=9000)],
                      "c_mktsegment", "segment")


@query("rule_z_score", """
WITH s AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, avg(value) m, stddev_samp(value) s FROM events GROUP BY 1)
SELECT e.day, 'value' AS "column", CAST(count(*) AS BIGINT) AS element_count,
  CAST(count(*) FILTER (WHERE abs(value - m) / s >= 3) AS BIGINT) AS unexpected_count,
  1.0 - count(*) FILTER (WHERE abs(value - m) / s >= 3) * 1.0 / count(*) >= 0.99 AS success
FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, value FROM events) e JOIN s ON e.day = s.day GROUP BY 1""")
def rule_z_score(spark, sf):
    e = with_partition(table(spark, sf, "events"), F.to_date("ts"))
    x = {"value": F.col("value")}
    stats = onepass.grouped_metrics(e, [PART], {"value__mean": F.avg("value"), "value__sd": F.stddev_samp("value")})
    z = distribution.z_outliers(e, [PART], x, stats, 3.0)
    return z.select(F.col(PART).alias("day"), "column", "element_count", "unexpected_count", "success")


_NAMES = ["^Customer#\\d{9}$"]


@query("rule_pattern", rule_sql("customer", "c_mktsegment", [
    ("pattern:c_name", "c_name IS NOT NULL", r"NOT regexp_matches(c_name, '^Customer#\d{9}$')"),
    ("pattern:even", "c_name IS NOT NULL", "NOT (regexp_matches(c_name, '[02]$') OR regexp_matches(c_name, '[468]$'))")],
    "segment"))
def rule_pattern(spark, sf):
    return rule_table(table(spark, sf, "customer"), [rules.matches_any("pattern:c_name", "c_name", _NAMES),
                                                     rules.matches_any("pattern:even", "c_name", ["[02]$", "[468]$"])],
                      "c_mktsegment", "segment")


@query("rule_length", rule_sql("pages", "substr(url, 1, 5)", [
    ("length:url", "url IS NOT NULL", "length(url) < 30 OR length(url) > 40"),
    ("length:html", "html IS NOT NULL", "length(html) > 5000")], "scheme"))
def rule_length(spark, sf):
    p = table(spark, sf, "pages").withColumn("scheme", F.substring("url", 1, 5))
    return rule_table(p, [rules.length_between("length:url", "url", 30, 40),
                          rules.length_between("length:html", "html", None, 5000)], "scheme", "scheme")


_DIRTY_SQL = {"padding": r"^\s|\s$", "blank": r"^\s*$", "control": r"[\x00-\x1F\x7F]", "markup": "[<>]|&#|&lt;|&gt;",
              "null_literal": r"\bnull\b|\bNULL\b|\bNone\b|^nan$|^NaN$"}


def _dirty_query(kind: str) -> None:
    pattern = next(p for k, p, _ in text.DIRTY_TEXT if k == kind)
    bad = f"regexp_matches({{c}}, '{_DIRTY_SQL[kind]}')"
    sql = (rule_sql("documents", "lang", [(f"{kind}:text", "text IS NOT NULL", bad.format(c="text"))], "slice")
           + "\nUNION ALL\n" + rule_sql("pages", "substr(url, 1, 5)", [(f"{kind}:html", "html IS NOT NULL", bad.format(c="html"))], "slice")
           + "\nUNION ALL\n" + rule_sql("conversations", "role", [(f"{kind}:turn", "text IS NOT NULL", bad.format(c="text"))], "slice"))

    @query(f"rule_no_{kind}", sql)
    def run(spark, sf):
        d = rule_table(table(spark, sf, "documents"), [rules.free_of(f"{kind}:text", "text", pattern)], "lang", "slice")
        pages = table(spark, sf, "pages").withColumn("scheme", F.substring("url", 1, 5))
        p = rule_table(pages, [rules.free_of(f"{kind}:html", "html", pattern)], "scheme", "slice")
        c = rule_table(table(spark, sf, "conversations"), [rules.free_of(f"{kind}:turn", "text", pattern)], "role", "slice")
        return d.unionByName(p).unionByName(c)


for _kind, _, _ in text.DIRTY_TEXT:
    _dirty_query(_kind)


@query("rule_ascii", rule_sql("documents", "lang", [
    ("ascii:source", "source IS NOT NULL", r"NOT regexp_matches(source, '^[\x20-\x7E]+$')"),
    ("ascii:text", "text IS NOT NULL", r"NOT regexp_matches(text, '^[\x20-\x7E]+$')")], "lang"))
def rule_ascii(spark, sf):
    return rule_table(table(spark, sf, "documents"), [
        rules.matches_any("ascii:source", "source", [text.PRINTABLE_ASCII]),
        rules.matches_any("ascii:text", "text", [text.PRINTABLE_ASCII])], "lang", "lang")


@query("rule_format", rule_sql(DAILY_EVENTS, "day", [
    ("format:props", "props IS NOT NULL", r"""NOT regexp_matches(props, '^\{"k": \d{2}\}$')"""),
    ("format_any:props", "props IS NOT NULL",
     r"""NOT (regexp_matches(props, '^\{"k": \d\}$') OR regexp_matches(props, '^\{"k": [1-8]\d\}$'))""")]))
def rule_format(spark, sf):
    return rule_table(daily_events(spark, sf), [
        rules.matches_any("format:props", "props", [r'^\{"k": \d{2}\}$']),
        rules.matches_any("format_any:props", "props", [r'^\{"k": \d\}$', r'^\{"k": [1-8]\d\}$'])])


@query("rule_equal_columns", rule_sql(
    "(SELECT lang, n_chars, CASE WHEN source <> 'src7' THEN length(text) END AS len, "
    "CASE WHEN source IN ('src7', 'src8') THEN NULL ELSE n_chars END AS copy FROM documents) d", "lang", [
        ("equal:n_chars,len", "n_chars IS NOT NULL OR len IS NOT NULL", "n_chars IS DISTINCT FROM len"),
        ("equal:copy,len", "copy IS NOT NULL OR len IS NOT NULL", "copy IS DISTINCT FROM len")], "lang"))
def rule_equal_columns(spark, sf):
    d = table(spark, sf, "documents").withColumns({
        "len": F.expr("CASE WHEN source <> 'src7' THEN length(text) END"),
        "copy": F.expr("CASE WHEN source IN ('src7', 'src8') THEN NULL ELSE n_chars END")})
    return rule_table(d, [rules.equal("equal:n_chars,len", "n_chars", "len"), rules.equal("equal:copy,len", "copy", "len")],
                      "lang", "lang")


@query("rule_time_order", rule_sql(
    "(SELECT l_returnflag, o_orderdate, CASE WHEN l_linenumber < 7 THEN l_shipdate END AS l_shipdate "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey) j", "l_returnflag", [
        ("ordered:l_shipdate,o_orderdate", "l_shipdate IS NOT NULL OR o_orderdate IS NOT NULL",
         "coalesce(l_shipdate < o_orderdate, true)")], "flag"))
def rule_time_order(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.withColumn("l_shipdate", F.expr("CASE WHEN l_linenumber < 7 THEN l_shipdate END"))
    return rule_table(j, [rules.at_least("ordered:l_shipdate,o_orderdate", "l_shipdate", "o_orderdate")], "l_returnflag", "flag")


_FLAGS = """(SELECT day, value, value IS NOT NULL AS has_value,
  CASE WHEN event_type IS NULL THEN NULL ELSE coalesce(value BETWEEN 1 AND 100, false) END AS valid FROM """ + DAILY_EVENTS + ") f"


@query("rule_flag_agrees", rule_sql(_FLAGS, "day", [
    ("flag:has_value", "true", "has_value IS DISTINCT FROM (value IS NOT NULL)"),
    ("flag:valid_1_100", "true", "valid IS DISTINCT FROM coalesce(value BETWEEN 1 AND 100, false)"),
    ("flag:valid_1_90", "true", "valid IS DISTINCT FROM coalesce(value BETWEEN 1 AND 90, false)")]))
def rule_flag_agrees(spark, sf):
    e = daily_events(spark, sf).withColumns({
        "has_value": F.col("value").isNotNull(),
        "valid": F.expr("CASE WHEN event_type IS NULL THEN NULL ELSE coalesce(value BETWEEN 1 AND 100, false) END")})
    x = F.col("value")
    return rule_table(e, [rules.flag_agrees("flag:has_value", "has_value", "value", rules.present(x)),
                          rules.flag_agrees("flag:valid_1_100", "valid", "value", rules.present_within(x, (1, 100))),
                          rules.flag_agrees("flag:valid_1_90", "valid", "value", rules.present_within(x, (1, 90)))])


@query("rule_flag_constant", rule_sql(
    "(SELECT l_returnflag, l_quantity > 0 AS positive, CASE WHEN l_discount > 0 THEN l_quantity > 25 END AS big FROM lineitem) l",
    "l_returnflag", [("constant:positive", "positive IS NOT NULL", "positive <> true"),
                     ("constant:big", "big IS NOT NULL", "big <> false")], "flag"))
def rule_flag_constant(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({"positive": F.expr("l_quantity > 0"),
                                                   "big": F.expr("CASE WHEN l_discount > 0 THEN l_quantity > 25 END")})
    return rule_table(li, [rules.constant("constant:positive", "positive", True),
                           rules.constant("constant:big", "big", False)], "l_returnflag", "flag")


@query("rule_allowed_values", rule_sql(DAILY_EVENTS, "day", [
    ("allowed:event_type", "event_type IS NOT NULL", "event_type NOT IN ('click', 'view', 'purchase')")]))
def rule_allowed_values(spark, sf):
    return rule_table(daily_events(spark, sf), [
        rules.in_set("allowed:event_type", "event_type", ["click", "view", "purchase"])])


@query("rule_predicate", rule_sql(DAILY_EVENTS, "day", [
    ("predicate:strict", "true", "NOT coalesce(value > 1 AND user_id >= 0, false)"),
    ("predicate:null_passes", "true", "NOT coalesce(value > 1 AND user_id >= 0, true)"),
    ("predicate:coupled", "true", "NOT ((value IS NULL) = (event_type IS NULL))")]))
def rule_predicate(spark, sf):
    return rule_table(daily_events(spark, sf), [
        rules.predicate("predicate:strict", "value > 1 AND user_id >= 0"),
        rules.predicate("predicate:null_passes", "value > 1 AND user_id >= 0", True),
        rules.predicate("predicate:coupled", "(value IS NULL) = (event_type IS NULL)")])


@query("rule_samples", """
WITH bad AS (SELECT l_returnflag AS flag, 'range:l_quantity' AS rule_id, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.0' AS v
             FROM lineitem WHERE l_quantity > 45
             UNION ALL SELECT l_returnflag, 'allowed:l_linestatus', l_linestatus FROM lineitem WHERE l_linestatus <> 'F'),
r AS (SELECT *, row_number() OVER (PARTITION BY flag, rule_id ORDER BY v) AS n FROM bad)
SELECT flag, rule_id, string_agg(v, ',' ORDER BY n) AS sample FROM r WHERE n <= 20 GROUP BY 1, 2""")
def rule_samples(spark, sf):
    s = onepass.samples(table(spark, sf, "lineitem"), ["l_returnflag"], [
        rules.between("range:l_quantity", "l_quantity", hi=45), rules.in_set("allowed:l_linestatus", "l_linestatus", ["F"])])
    return s.select(F.col("l_returnflag").alias("flag"), "rule_id", F.array_join("sample", ",").alias("sample"))


_RAISING = {"zero": "100 / (event_id % 7) > 0", "zero_on_a_day": "1 / (day(ts) - 5) <> 0", "overflow": "event_id * 9223372036854775807L >= 0",
            "bad_cast": "CAST(event_type AS INT) > 0", "fine": "value > 10", "gone": "no_such_column > 1"}


@query("rule_errors", f"""
WITH d AS (SELECT day, CAST(count(*) AS BIGINT) AS n, CAST(count(event_type) AS BIGINT) AS typed, max(event_id) AS most, count(*) FILTER (WHERE event_id % 7 = 0) AS zeros,
  CAST(count(*) FILTER (WHERE NOT coalesce(value > 10, false)) AS BIGINT) AS low, day(CAST(day AS DATE)) AS of_month FROM {DAILY_EVENTS} GROUP BY 1),
r AS (SELECT day, '6.predicate.gone' AS rule_id, 0::BIGINT AS unexpected, true AS has_error FROM d
UNION ALL SELECT day, '6.predicate.zero', 0, zeros > 0 FROM d
UNION ALL SELECT day, '6.predicate.zero_on_a_day', 0, of_month = 5 FROM d
UNION ALL SELECT day, '6.predicate.overflow', 0, most > 1 FROM d
UNION ALL SELECT day, '6.predicate.bad_cast', 0, typed > 0 FROM d
UNION ALL SELECT day, '6.predicate.fine', low, false FROM d
UNION ALL SELECT day, '6.allowed_values.event_type', typed, false FROM d
UNION ALL SELECT day, '6.allowed_values.props', n, false FROM d
UNION ALL SELECT day, '4.not_null.lost', 0, true FROM d
UNION ALL SELECT day, '4.not_null.event_id', 0, false FROM d)
SELECT *, unexpected = 0 AND NOT has_error AS success FROM r""")
def rule_errors(spark, sf):
    """Rules that can't work or raise errors are rows like any other, failed in the partitions where they do.

    Division by zero everywhere and on one day, overflow, a bad cast, an unknown column, allowed values of other types.
    """
    c = parse_contract("events", {
        "kolom": [{"nama": "event_id", "tipe": "integer"}, {"nama": "event_type", "wajib": False}, {"nama": "lost", "tipe": "integer"}],
        "validasi": {"data_quality": [{"check": k, "validation": v, "columns": []} for k, v in _RAISING.items()]},
        "distribusi": [{"kolom": "event_type", "expected_values": [1, 2]}]})
    c.columns.append(ColumnContract("props", allowed=[dt.date(2024, 1, 1), dt.datetime(2024, 1, 2, 3), True]))
    e = daily_events(spark, sf)
    r = evaluate(e, c, bl.learn(e, c), now=dt.datetime(2024, 6, 1))
    shown = r.filter((F.col("rule_kind") == "predicate") | F.col("rule_id").isin(
        "6.allowed_values.event_type", "6.allowed_values.props", "4.not_null.lost", "4.not_null.event_id"))
    return shown.select(F.col("part_date").cast("string").alias("day"), "rule_id", "success",
                        F.coalesce("unexpected_count", F.lit(0)).alias("unexpected"), F.col("error").isNotNull().alias("has_error"))
