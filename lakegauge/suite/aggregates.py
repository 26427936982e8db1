"""Scalar and distinct metrics per partition, order statistics, histograms, divergence."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakegauge.functions import times
from lakegauge.operators import distribution, keys, onepass, order_stats
from lakegauge.operators.prepare import with_partition
from lakegauge.plans import baseline as bl
from lakegauge.suite import query
from lakegauge.suite.common import DAILY_EVENTS, PART, PART_DATE, daily_events, table

DAY = "CAST(CAST(ts AS DATE) AS VARCHAR)"
_LI = "l_returnflag || l_linestatus"


def _events(spark, sf):
    return with_partition(table(spark, sf, "events"), F.to_date("ts"))


def _day(df):
    return df.withColumnRenamed(PART, "day")


@query("volume_checks", f"""
WITH n AS (SELECT {DAY} AS day, count(*) AS r, count(DISTINCT user_id) AS u FROM events GROUP BY 1),
m AS (SELECT floor(median(r)) AS med FROM n WHERE day < (SELECT max(day) FROM n)),
h AS (SELECT min(u) AS lo, max(u) AS hi FROM n WHERE day < (SELECT max(day) FROM n))
SELECT day, CAST(r AS BIGINT) AS "rows", CAST(u AS BIGINT) AS entities, r >= 1 AS not_empty,
  r BETWEEN floor(med * 0.85) AND floor(med * 1.15) AS in_corridor, r <= u * 24 AS within_capacity,
  u BETWEEN lo AND hi AS entities_in_range FROM n, m, h""")
def volume_checks(spark, sf):
    """Not empty, row corridor, physical capacity and entity corridor against a baseline without the newest day."""
    e = _events(spark, sf)
    n = onepass.grouped_metrics(e, [PART], {"rows": F.count(F.lit(1))}).join(
        keys.distinct_count(e, [PART], "user_id", "entities"), PART)
    history, _ = bl.exclude_partitions(e)
    old = onepass.grouped_metrics(history, [PART], {"rows": F.count(F.lit(1))})
    v = bl.volume_corridor(old, 0.15).first()
    h = keys.distinct_count(history, [PART], "user_id").agg(F.min("distinct_count"), F.max("distinct_count")).first()
    return n.select(
        F.col(PART).alias("day"), "rows", "entities", (F.col("rows") >= 1).alias("not_empty"),
        F.col("rows").between(v["rows_low"], v["rows_high"]).alias("in_corridor"),
        (F.col("rows") <= F.col("entities") * 24).alias("within_capacity"),
        F.col("entities").between(h[0], h[1]).alias("entities_in_range"))


@query("window_reached", f"""
SELECT {DAY} AS day, max(ts) AS latest, max(ts) >= CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) + INTERVAL 20 HOUR AS reaches_end,
  CAST(count(DISTINCT hour(ts)) AS BIGINT) AS periods, count(DISTINCT hour(ts)) = 24 AS all_periods FROM events GROUP BY 1""")
def window_reached(spark, sf):
    m = onepass.grouped_metrics(_events(spark, sf), [PART, PART_DATE], {
        "latest": F.max("ts"), "periods": times.distinct_periods(F.hour("ts"))})
    start = times.window_start(F.col(PART_DATE))
    return m.select(F.col(PART).alias("day"), "latest",
                    F.col("latest").between(start + F.expr("INTERVAL 20 HOURS"), times.window_end(start)).alias("reaches_end"),
                    "periods", (F.col("periods") == 24).alias("all_periods"))


@query("present_share", f"""
SELECT day, CAST(count(*) AS BIGINT) AS "rows", CAST(count(value) AS BIGINT) AS present, round(count(value) * 1.0 / count(*), 6) AS share,
  count(value) * 1.0 / count(*) >= 0.95 AS success FROM {DAILY_EVENTS} GROUP BY 1""")
def present_share(spark, sf):
    m = onepass.grouped_metrics(daily_events(spark, sf), [PART], {"rows": F.count(F.lit(1)), "present": F.count("value")})
    share = F.col("present") / F.col("rows")
    return m.select(F.col(PART).alias("day"), "rows", "present", F.round(share, 6).alias("share"), (share >= 0.95).alias("success"))


@query("null_limit", f"""
SELECT "column", round(avg(CASE WHEN miss THEN 1.0 ELSE 0.0 END), 6) AS null_share,
  avg(CASE WHEN miss THEN 1.0 ELSE 0.0 END) <= 0.1 AS success FROM (
  SELECT 'event_type' AS "column", event_type IS NULL AS miss FROM {DAILY_EVENTS}
  UNION ALL SELECT 'value', value IS NULL FROM {DAILY_EVENTS}) x GROUP BY 1""")
def null_limit(spark, sf):
    e = daily_events(spark, sf)
    m = e.agg(F.count(F.lit(1)).alias("n"), F.count("event_type").alias("a"), F.count("value").alias("b"))
    rows = [F.struct(F.lit(c).alias("column"), (1 - F.col(x) / F.col("n")).alias("share"))
            for c, x in (("event_type", "a"), ("value", "b"))]
    return m.select(F.inline(F.array(*rows))).select("column", F.round("share", 6).alias("null_share"),
                                                     (F.col("share") <= 0.1).alias("success"))


def _unique_sql(rule: str, source: str, group: str, key: list[str]) -> str:
    k = ", ".join(key)
    return f"""SELECT g AS slice, '{rule}' AS rule_id, CAST(sum(n) AS BIGINT) AS element_count,
  CAST(sum(CASE WHEN n > 1 AND tested THEN n ELSE 0 END) AS BIGINT) AS unexpected_count,
  sum(CASE WHEN n > 1 AND tested THEN n ELSE 0 END) = 0 AS success
FROM (SELECT {group} AS g, {k}, count(*) AS n, {' OR '.join(f'{x} IS NOT NULL' for x in key)} AS tested FROM {source}
      GROUP BY {group}, {k}) c GROUP BY 1"""


def _unique(df, group, key, rule):
    return keys.uniqueness(df, [group], key, rule).select(
        F.col(group).cast("string").alias("slice"), "rule_id", "element_count", "unexpected_count", "success")


@query("key_unique", _unique_sql("event_id", "(SELECT *, " + DAY + " AS day FROM events) e", "day", ["event_id"])
       + " UNION ALL " + _unique_sql("l_orderkey", "lineitem", "l_returnflag", ["l_orderkey"])
       + " UNION ALL " + _unique_sql("value", DAILY_EVENTS, "day", ["value"]))
def key_unique(spark, sf):
    return (_unique(_events(spark, sf), PART, ["event_id"], "event_id")
            .unionByName(_unique(table(spark, sf, "lineitem"), "l_returnflag", ["l_orderkey"], "l_orderkey"))
            .unionByName(_unique(daily_events(spark, sf), PART, ["value"], "value")))


@query("key_compound_unique", _unique_sql("order_line", "lineitem", "l_returnflag", ["l_orderkey", "l_linenumber"])
       + " UNION ALL " + _unique_sql("type_value", DAILY_EVENTS, "day", ["event_type", "value"]))
def key_compound_unique(spark, sf):
    return (_unique(table(spark, sf, "lineitem"), "l_returnflag", ["l_orderkey", "l_linenumber"], "order_line")
            .unionByName(_unique(daily_events(spark, sf), PART, ["event_type", "value"], "type_value")))


@query("key_one_per_period", _unique_sql("user_hour", "(SELECT user_id, date_trunc('hour', ts) AS h, " + DAY
                                         + " AS day FROM events) e", "day", ["user_id", "h"]))
def key_one_per_period(spark, sf):
    e = _events(spark, sf).withColumn("h", times.period_floor(F.col("ts"), "jam"))
    return _unique(e, PART, ["user_id", "h"], "user_hour")


@query("duplicate_limit", """
SELECT l_returnflag AS flag, CAST(count(*) AS BIGINT) AS element_count,
  CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS surplus_rows,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) <= 10 AS success FROM lineitem GROUP BY 1""")
def duplicate_limit(spark, sf):
    return keys.duplicate_rows(table(spark, sf, "lineitem"), ["l_returnflag"], ["l_orderkey", "l_linenumber"], 10) \
        .withColumnRenamed("l_returnflag", "flag")


@query("key_stability", f"""
WITH c AS (SELECT {DAY} AS day, user_id, hour(ts) AS h, count(*) AS n FROM events GROUP BY 1, 2, 3),
w AS (SELECT user_id, h, sum(n) AS n, max(n) AS m FROM c GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(count(*) AS BIGINT) AS distinct_keys, max(m) <= 1 AS unique_per_partition,
  max(n) <= 1 AS unique_overall FROM w""")
def key_stability(spark, sf):
    return keys.key_stability(_events(spark, sf).withColumn("h", F.hour("ts")), PART, ["user_id", "h"])


@query("distinct_entities", f"SELECT {DAY} AS day, CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_count FROM events GROUP BY 1")
def distinct_entities(spark, sf):
    return _day(keys.distinct_count(_events(spark, sf), [PART], "user_id"))


@query("distinct_entities_estimate")
def distinct_entities_estimate(spark, sf):
    return _day(keys.approx_distinct_count(_events(spark, sf), [PART], "user_id"))


@query("distinct_entities_within_error", f"SELECT {DAY} AS day, count(DISTINCT user_id) AS entities, true AS within FROM events GROUP BY 1")
def distinct_entities_within_error(spark, sf):
    """The estimate is within five of its standard errors of the exact count, on every day."""
    e, error = _events(spark, sf), 0.02
    n = keys.distinct_count(e, [PART], "user_id", "entities").join(keys.approx_distinct_count(e, [PART], "user_id", error), PART)
    off = F.abs(F.col("distinct_count") - F.col("entities"))
    return _day(n.select(PART, "entities", (off <= F.greatest(F.lit(1.0), 5 * error * F.col("entities"))).alias("within")))


@query("mean_and_deviation", f"""
SELECT {DAY} AS day, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, avg(value) BETWEEN 40 AND 60 AS mean_ok,
  stddev_samp(value) BETWEEN 0 AND 50 AS sd_ok FROM events GROUP BY 1""")
def mean_and_deviation(spark, sf):
    m = onepass.grouped_metrics(_events(spark, sf), [PART], {"m": F.avg("value"), "s": F.stddev_samp("value")})
    return m.select(F.col(PART).alias("day"), F.round("m", 6).alias("mean"), F.round("s", 6).alias("sd"),
                    F.col("m").between(40, 60).alias("mean_ok"), F.col("s").between(0, 50).alias("sd_ok"))


_ZEROED = f"(SELECT {DAY} AS day, CASE WHEN value < 60 THEN 0 ELSE value END AS z, value, -value AS neg FROM events) e"


@query("median_is_zero", f"SELECT day, median(z) AS median, median(z) = 0 AS success FROM {_ZEROED} GROUP BY 1")
def median_is_zero(spark, sf):
    z = F.when(F.col("value") < 60, 0.0).otherwise(F.col("value"))
    m = order_stats.median(order_stats.long_values(_events(spark, sf), [PART], {"z": z}), [PART])
    return m.select(F.col(PART).alias("day"), "median", (F.col("median") == 0).alias("success"))


def _quantile_sql(rank: str) -> str:
    parts = [f"""SELECT day, '{col}' AS "column", '{q}' AS q, v AS value FROM (
  SELECT day, {col} AS v, row_number() OVER (PARTITION BY day ORDER BY {col}) - 1 AS i, count(*) OVER (PARTITION BY day) AS n
  FROM {_ZEROED}) r WHERE i = {rank.format(q=q)}""" for col in ("value", "z", "neg") for q in (0.5, 0.75, 0.95, 0.99)]
    return "\nUNION ALL\n".join(parts)


def _quantiles(spark, sf, definition, one_job=False):
    cols = {"value": F.col("value"), "z": F.when(F.col("value") < 60, 0.0).otherwise(F.col("value")), "neg": -F.col("value")}
    long = order_stats.long_values(_events(spark, sf), [PART], cols)
    q = order_stats.quantiles(long, [PART], [0.5, 0.75, 0.95, 0.99], definition, one_job)
    return q.select(F.col(PART).alias("day"), "column", F.col("name").alias("q"), "value")


@query("quantiles_lower", _quantile_sql("floor({q}::DOUBLE * (n - 1))"))
def quantiles_lower(spark, sf):
    return _quantiles(spark, sf, "lower")


@query("quantiles_nearest", _quantile_sql("round_even({q}::DOUBLE * (n - 1), 0)"))
def quantiles_nearest(spark, sf):
    return _quantiles(spark, sf, "nearest")


@query("quantiles_in_one_job", _quantile_sql("round_even({q}::DOUBLE * (n - 1), 0)"))
def quantiles_in_one_job(spark, sf):
    """The same figures, counted by value at once."""
    return _quantiles(spark, sf, "nearest", one_job=True)


@query("quantiles_of_all_rows", """
SELECT returnflag, 'l_extendedprice' AS "column", q, v AS value FROM (
  SELECT l_returnflag AS returnflag, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i,
    count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) r
JOIN (SELECT unnest([0.5, 0.75, 0.9, 0.95, 0.99]) AS p, unnest(['0.5', '0.75', '0.9', '0.95', '0.99']) AS q) s
  ON i = floor(p::DOUBLE * (n - 1))""")
def quantiles_of_all_rows(spark, sf):
    long = order_stats.long_values(table(spark, sf, "lineitem"), ["l_returnflag"], {"l_extendedprice": F.col("l_extendedprice")})
    q = order_stats.quantiles(long, ["l_returnflag"], [0.5, 0.75, 0.9, 0.95, 0.99])
    return q.select(F.col("l_returnflag").alias("returnflag"), "column", F.col("name").alias("q"), "value")


@query("quantile_sketch")
def quantile_sketch(spark, sf):
    return _day(order_stats.approx_quantiles(_events(spark, sf), [PART], "value", [0.5, 0.95]))


@query("quantile_sketch_within_rank", f"""
SELECT {DAY} AS day, q, count(value) AS n, true AS within FROM events, (VALUES (0.5::DOUBLE), (0.95::DOUBLE)) s(q) GROUP BY 1, 2""")
def quantile_sketch_within_rank(spark, sf):
    """Ranks of the sketched values differ from those asked for by one in ten thousand rows at most (and one row)."""
    e, qs, accuracy = _events(spark, sf).select(PART, "value"), [0.5, 0.95], 10_000
    v = e.join(order_stats.approx_quantiles(e, [PART], "value", qs, accuracy), PART)
    ranks = F.array(*[F.struct(F.lit(q).alias("q"), F.count_if(F.col("value") < F.col("quantiles")[i]).alias("below"),
                               F.count_if(F.col("value") <= F.col("quantiles")[i]).alias("upto")) for i, q in enumerate(qs)])
    r = v.groupBy(PART).agg(F.count("value").alias("n"), ranks.alias("ranks")).select(PART, "n", F.inline("ranks"))
    asked, slack = F.col("q") * F.col("n"), F.col("n") / accuracy + 1
    return _day(r.select(PART, "q", "n", asked.between(F.col("below") - slack, F.col("upto") + slack).alias("within")))


_FRACTIONS = "[0.0, 0.0001, 0.003, 0.013, 0.033, 0.066, 0.133, 0.333, 1.0]"
_EDGES = f"""s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
f AS (SELECT unnest({_FRACTIONS})::DOUBLE AS f, unnest(range(9)) AS i),
e AS (SELECT i, round(lo + f * (hi - lo), 6) AS edge FROM f, s),
b AS (SELECT a.i AS bin, a.edge AS low, z.edge AS high FROM e a JOIN e z ON z.i = a.i + 1)"""


@query("histogram_skewed_bins", f"""WITH {_EDGES}
SELECT 'value' AS "column", CAST(bin AS INTEGER) AS bin, low, high, CAST(count(value) AS BIGINT) AS "rows"
FROM b LEFT JOIN events ON value >= low AND (value < high OR (bin = 7 AND value <= high)) GROUP BY 2, 3, 4""")
def histogram_skewed_bins(spark, sf):
    e = table(spark, sf, "events")
    lo, hi = e.agg(F.min("value"), F.max("value")).first()
    return bl.histogram(e, {"value": F.col("value")}, {"value": distribution.edges(lo, hi)})


@query("divergence_from_baseline", f"""WITH {_EDGES},
t AS (SELECT count(*) AS n FROM events, s WHERE value >= round(lo, 6) AND value <= round(hi, 6)),
w AS (SELECT bin, low, high, count(value) * 1.0 / (SELECT n FROM t) AS w FROM b
      LEFT JOIN events ON value >= low AND (value < high OR (bin = 7 AND value <= high)) GROUP BY 1, 2, 3),
held AS (SELECT bin, low, high, CASE WHEN w = 0 THEN 0.01 / (SELECT count(*) FROM w WHERE w = 0) ELSE w * 0.98 END AS q FROM w
  UNION ALL SELECT -1, NULL, (SELECT min(low) FROM w), 0.005 UNION ALL SELECT 99, (SELECT max(high) FROM w), NULL, 0.005),
ev AS (SELECT {DAY} AS day, value FROM events), d AS (SELECT day, count(*) AS n FROM ev GROUP BY 1),
c AS (SELECT day, h.bin, any_value(h.q) / (SELECT sum(q) FROM held) AS q, count(*) AS c FROM ev JOIN held h ON
  CASE h.bin WHEN -1 THEN value < h.high WHEN 99 THEN value > h.low ELSE value >= h.low AND (value < h.high OR (h.bin = 7 AND value <= h.high)) END
  GROUP BY 1, 2)
SELECT c.day, round(sum(c * 1.0 / n * ln(c * 1.0 / n / q)), 6) AS kl, sum(c * 1.0 / n * ln(c * 1.0 / n / q)) <= 1 AS success
FROM c JOIN d ON c.day = d.day GROUP BY 1""")
def divergence_from_baseline(spark, sf):
    e = _events(spark, sf)
    lo, hi = e.agg(F.min("value"), F.max("value")).first()
    bins = distribution.edges(lo, hi)
    hist = [r["rows"] for r in bl.histogram(e, {"value": F.col("value")}, {"value": bins}).orderBy("bin").collect()]
    counts = distribution.bin_counts(F.col("value"), bins)
    m = onepass.grouped_metrics(e, [PART], counts)
    kl = distribution.divergence([F.col(k) for k in counts], [h / sum(hist) for h in hist])
    return m.select(F.col(PART).alias("day"), F.round(kl, 6).alias("kl"), (kl <= 1).alias("success"))


@query("expected_ratio", f"""
SELECT {DAY} AS day, CAST(count(*) AS BIGINT) AS element_count, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS observed,
  abs(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END) - 0.37) <= 0.03 AS success FROM events GROUP BY 1""")
def expected_ratio(spark, sf):
    e = _events(spark, sf).withColumn("big", F.col("value") > 50)
    r = distribution.ratio_within(e, [PART], "big", 0.37, 0.03)
    return r.select(F.col(PART).alias("day"), "element_count", F.round("observed_num", 6).alias("observed"), "success")


@query("value_shares", f"""
SELECT day, coalesce(event_type, '(none)') AS event_type, CAST(count(*) AS BIGINT) AS "rows",
  round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY day), 6) AS share FROM {DAILY_EVENTS} GROUP BY 1, 2""")
def value_shares(spark, sf):
    s = distribution.value_shares(daily_events(spark, sf), [PART], "event_type")
    return s.select(F.col(PART).alias("day"), F.coalesce("event_type", F.lit("(none)")).alias("event_type"), "rows",
                    F.round("share", 6).alias("share"))
