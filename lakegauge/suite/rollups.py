"""Sweeps and roll-ups of check results."""

from __future__ import annotations

import datetime as dt
import time

import pyarrow as pa
from pyspark.sql import functions as F

from lakegauge.contract import parse_contract
from lakegauge.functions import text
from lakegauge.operators.distribution import EDGE_FRACTIONS
from lakegauge.operators.prepare import PART, with_partition
from lakegauge.plans import baseline as bl
from lakegauge.plans import evaluate as ev
from lakegauge.plans import history, summary
from lakegauge.plans.catalog import CATEGORIES
from lakegauge.session import materialise, scratch_path, small_table
from lakegauge.suite import query
from lakegauge.suite.baselines import HISTORY, contract
from lakegauge.suite.common import DAILY_EVENTS, daily_events, rule_sql, table

NOW = dt.datetime(2024, 2, 1)
_SWEEPS: dict[tuple[str, str], object] = {}


def sweep_of_events(spark, sf):
    """check_results of every day of events, evaluated once per session and stored."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SWEEPS:
        e = daily_events(spark, sf)
        states = bl.gather(e, contract())
        b = bl.learn_from(states, contract(), now=NOW)
        _SWEEPS[key] = materialise(ev.evaluate(e, contract(), b, now=NOW, run_id="run-1", states=states), "check_results")
    return _SWEEPS[key]


def _sweep_sql() -> str:
    """The sweep spelled out in SQL: every rule of the events contract against the learned baseline."""
    t, f = "event_type IS NOT NULL", "regexp_matches({c}, '{p}')"
    rows = [("4.not_null.event_id", "true", "event_id IS NULL"), ("4.not_null.ts", "true", "ts IS NULL"),
            ("4.not_null.user_id", "true", "user_id IS NULL"), ("4.not_null.props", "true", "props IS NULL"),
            ("4.not_empty_text.event_type", t, "length(event_type) < 1"), ("4.not_empty_text.props", "true", "length(props) < 1"),
            ("3.in_window.ts", "true", "false"), ("3.not_future.ts", "true", "ts > TIMESTAMP '2024-02-01 00:00:00'"),
            ("3.on_grid.ts", "true", "ts <> date_trunc('hour', ts)"),
            ("7.physical_range.value", "value IS NOT NULL", "value < 0.05 OR value > 140"),
            ("10.format.props", "true", r"""NOT regexp_matches(props, '^\{"k": \d+\}$')"""),
            ("8.ascii.event_type", t, r"NOT regexp_matches(event_type, '^[\x20-\x7E]+$')"),
            ("8.pattern.event_type", t, f"length(event_type) NOT BETWEEN (SELECT min(length(event_type)) FROM {HISTORY}) AND (SELECT max(length(event_type)) FROM {HISTORY})"),
            ("8.length.event_type", t, f"length(event_type) NOT BETWEEN (SELECT min(length(event_type)) FROM {HISTORY}) AND (SELECT max(length(event_type)) FROM {HISTORY})"),
            ("8.pattern.props", "true", f"length(props) NOT BETWEEN (SELECT min(length(props)) FROM {HISTORY}) AND (SELECT max(length(props)) FROM {HISTORY})"),
            ("8.length.props", "true", f"length(props) NOT BETWEEN (SELECT min(length(props)) FROM {HISTORY}) AND (SELECT max(length(props)) FROM {HISTORY})"),
            ("6.in_master.event_type", t, f"event_type NOT IN (SELECT event_type FROM {HISTORY} WHERE event_type IS NOT NULL)")]
    for kind, pattern, _ in text.DIRTY_TEXT:
        for c in ("event_type", "props"):
            rows.append((f"8.no_{kind}.{c}", f"{c} IS NOT NULL", f.format(c=c, p=pattern)))
    counted = rule_sql("d", "day", rows)
    fractions = ", ".join(str(x) for x in EDGE_FRACTIONS)

    def unique(rule, key):
        return (f"SELECT day, '{rule}', CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT), sum(CASE WHEN n > 1 THEN n ELSE 0 END) = 0 "
                f"FROM (SELECT day, {key}, count(*) AS n FROM d GROUP BY ALL) u GROUP BY day")

    def scalar(rule, cond):
        return f"SELECT day, '{rule}', -1::BIGINT, {cond} FROM m, b"
    constant = ["1.column_count", "1.column_set", *[f"1.type.{c}" for c in ("event_id", "ts", "user_id", "event_type", "value", "props")]]
    skipped = ["9.reconcile", "11.size", "12.lineage"]
    return f"""
WITH d AS (SELECT * FROM {DAILY_EVENTS}),
h AS (SELECT *, CASE WHEN value BETWEEN 0.05 AND 140 THEN value END AS v FROM d WHERE day < (SELECT max(day) FROM d)),
m AS (SELECT day, count(*) AS r, count(DISTINCT user_id) AS u, count(DISTINCT hour(ts)) AS p, max(ts) AS mx, count(value) AS c, count(event_type) AS ct,
        avg(value) AS mean, stddev_samp(value) AS sd, count(DISTINCT event_type) AS codes FROM d GROUP BY 1),
hp AS (SELECT day, count(*) AS r, count(DISTINCT user_id) AS u, count(DISTINCT hour(ts)) AS p, count(value) * 1.0::DOUBLE / count(*) AS cv,
        count(event_type) * 1.0::DOUBLE / count(*) AS cc, avg(v) AS mean, stddev_pop(v) AS sd FROM h GROUP BY 1),
b AS (SELECT floor(floor(median(r)) * 0.85) AS lo, floor(floor(median(r)) * 1.15) AS hi, min(u) AS ulo, max(u) AS uhi, max(p) AS p,
        round_even(greatest(0.0, 1 - (max(1 - cv) + 0.05)), 4) AS share, round_even(greatest(0.0, 1 - (max(1 - cc) + 0.05)), 4) AS cshare, round(max(mean) * 2, 6) AS mhi, round(max(sd) * 2, 6) AS shi FROM hp),
q AS (SELECT unnest([0.5, 0.75, 0.95, 0.99])::DOUBLE AS q),
hr AS (SELECT day, v, row_number() OVER (PARTITION BY day ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY day) AS n FROM h WHERE v IS NOT NULL),
qb AS (SELECT q, min(v) * 0.5 AS lo, least(max(v) * 1.5, 140) AS hi FROM hr, q WHERE i = floor(q * (n - 1)) GROUP BY 1),
dr AS (SELECT day, value AS v, row_number() OVER (PARTITION BY day ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY day) AS n FROM d WHERE value IS NOT NULL),
dq AS (SELECT day, q, v FROM dr, q WHERE i = round_even(q * (n - 1), 0)),
f AS (SELECT unnest([{fractions}])::DOUBLE AS f, unnest(range(9)) AS i),
e AS (SELECT i, round(0.05 + f * 139.95, 6) AS edge FROM f),
bins AS (SELECT a.i AS bin, a.edge AS low, z.edge AS high FROM e a JOIN e z ON z.i = a.i + 1),
w AS (SELECT bin, low, high, count(v) * 1.0 / (SELECT count(v) FROM h) AS w FROM bins LEFT JOIN h ON v >= low AND (v < high OR (bin = 7 AND v <= high)) GROUP BY 1, 2, 3),
held AS (SELECT bin, low, high, CASE WHEN w = 0 THEN 0.01 / (SELECT count(*) FROM w WHERE w = 0) ELSE w * 0.98 END AS q FROM w
  UNION ALL SELECT -1, NULL, 0.05, 0.005 UNION ALL SELECT 99, 140.0, NULL, 0.005),
kc AS (SELECT day, k.bin, any_value(k.q) / (SELECT sum(q) FROM held) AS q, count(*) AS c FROM d JOIN held k ON
  CASE k.bin WHEN -1 THEN value < k.high WHEN 99 THEN value > k.low ELSE value >= k.low AND (value < k.high OR (k.bin = 7 AND value <= k.high)) END GROUP BY 1, 2),
kl AS (SELECT kc.day, sum(kc.c * 1.0 / m.c * ln(kc.c * 1.0 / m.c / q)) AS kl FROM kc JOIN m ON kc.day = m.day GROUP BY 1),
r(day, rule_id, unexpected_count, success) AS (
  SELECT day, rule_id, unexpected_count, success FROM ({counted}) x
  UNION ALL {unique('5.surrogate_unique.event_id', 'event_id')}
  UNION ALL {unique('5.business_unique.user_id+ts', 'user_id, ts')}
  UNION ALL {unique('5.one_per_period.user_id+_period_floor', "user_id, date_trunc('hour', ts) AS t")}
  UNION ALL {scalar('2.not_empty', 'r >= 1')}
  UNION ALL {scalar('2.row_corridor', 'r BETWEEN lo AND hi')}
  UNION ALL {scalar('2.capacity.user_id', 'r BETWEEN 1 AND u * b.p')}
  UNION ALL {scalar('2.entity_corridor.user_id', 'u BETWEEN ulo AND uhi')}
  UNION ALL {scalar('3.reaches_end.ts', 'mx >= CAST(day AS TIMESTAMP) + INTERVAL 20 HOUR')}
  UNION ALL {scalar('3.all_periods.ts', 'm.p = b.p')}
  UNION ALL {scalar('4.present_share.value', 'c * 1.0::DOUBLE / r >= share')}
  UNION ALL {scalar('4.present_share.event_type', 'ct * 1.0::DOUBLE / r >= cshare')}
  UNION ALL {scalar('7.mean_corridor.value', 'mean BETWEEN 0.05 AND mhi')}
  UNION ALL {scalar('7.stdev_corridor.value', 'sd BETWEEN 0 AND shi')}
  UNION ALL {scalar('7.same_set.event_type', f'codes = (SELECT count(DISTINCT event_type) FROM {HISTORY})')}
  UNION ALL SELECT day, '7.quantile_shape.value', -1, bool_and(v BETWEEN lo AND hi) FROM dq JOIN qb ON dq.q = qb.q GROUP BY 1
  UNION ALL SELECT day, '7.kl_divergence.value', -1, kl <= 1 FROM kl
  UNION ALL SELECT d.day, '7.z_score.value', count(*) FILTER (WHERE abs(value - mean) / sd >= 20), true FROM d JOIN m ON d.day = m.day GROUP BY 1
  {' '.join(f"UNION ALL SELECT day, '{c}', -1, true FROM m" for c in constant)}
  {' '.join(f"UNION ALL SELECT day, '{c}', -1, NULL FROM m" for c in skipped)})
"""


_SWEEP = _sweep_sql()
_WARN = """(rule_id IN ('3.reaches_end.ts', '3.all_periods.ts', '3.on_grid.ts', '5.one_per_period.user_id+_period_floor', '7.z_score.value', '7.same_set.event_type')
  OR rule_id LIKE '8.no_markup%' OR rule_id LIKE '8.no_null_literal%')"""
_SEVERITY = f"CASE WHEN success IS NULL THEN 'skipped' WHEN {_WARN} THEN 'warning' ELSE 'blocking' END"


@query("sweep_results", _SWEEP + f"""SELECT day, rule_id, {_SEVERITY} AS severity, CASE WHEN success IS NULL THEN 'skip' WHEN success THEN 'pass' ELSE 'fail' END AS outcome,
  CAST(unexpected_count AS BIGINT) AS unexpected_count FROM r""")
def sweep_results(spark, sf):
    """All twelve dimensions on every day of events: baseline learned, 55 rules evaluated on 30 partitions at once."""
    r = sweep_of_events(spark, sf)
    outcome = F.when(F.col("success").isNull(), "skip").when(F.col("success"), "pass").otherwise("fail")
    return r.select(F.col("partition").alias("day"), "rule_id", "severity", outcome.alias("outcome"),
                    F.coalesce("unexpected_count", F.lit(-1)).alias("unexpected_count"))


_TOTALS = f"""CAST(count(*) FILTER (WHERE success) AS BIGINT) AS pass, CAST(count(*) FILTER (WHERE NOT success) AS BIGINT) AS fail,
  CAST(count(*) FILTER (WHERE success IS NULL) AS BIGINT) AS skip, CAST(count(*) FILTER (WHERE NOT success AND NOT {_WARN}) AS BIGINT) AS fail_blocking,
  CAST(count(*) FILTER (WHERE NOT success AND {_WARN}) AS BIGINT) AS fail_warning, CAST(count(*) AS BIGINT) AS checks"""


@query("sweep_verdicts", _SWEEP + f"""SELECT r.day, CAST(any_value(m.r) AS BIGINT) AS "rows", {_TOTALS},
  CASE WHEN count(*) FILTER (WHERE NOT success AND NOT {_WARN}) = 0 THEN 'LAYAK' ELSE 'TIDAK LAYAK' END AS verdict
FROM r JOIN m ON r.day = m.day GROUP BY 1""")
def sweep_verdicts(spark, sf):
    return summary.sweep(sweep_of_events(spark, sf)).drop("dataset", "part_date").withColumnRenamed("partition", "day")


@query("sweep_totals", _SWEEP + f"""SELECT CAST(count(*) AS BIGINT) AS partitions, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS fit, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS unfit
FROM (SELECT day, count(*) FILTER (WHERE NOT success AND NOT {_WARN}) = 0 AS ok FROM r GROUP BY 1) v""")
def sweep_totals(spark, sf):
    return summary.sweep_totals(summary.sweep(sweep_of_events(spark, sf))).drop("dataset")


@query("sweep_blocking_failures", _SWEEP + f"""SELECT day, rule_id, CAST(unexpected_count AS BIGINT) AS unexpected_count FROM r WHERE NOT success AND NOT {_WARN}""")
def sweep_blocking_failures(spark, sf):
    return summary.blocking_failures(sweep_of_events(spark, sf)).select(
        F.col("partition").alias("day"), "rule_id", F.coalesce("unexpected_count", F.lit(-1)).alias("unexpected_count"))


@query("validate_one_partition", _SWEEP + f"""SELECT rule_id, {_SEVERITY} AS severity, CASE WHEN success IS NULL THEN 'skip' WHEN success THEN 'pass' ELSE 'fail' END AS outcome
FROM r WHERE day = (SELECT max(day) FROM r)""")
def validate_one_partition(spark, sf):
    """The newest day alone: the sweep's plan behind a partition filter."""
    e = daily_events(spark, sf)
    b = bl.learn(e, contract(), now=NOW)
    newest = e.select(PART).distinct().agg(F.max(PART)).first()[0]
    r = ev.evaluate(e.filter(F.col(PART) == newest), contract(), b, now=NOW)
    outcome = F.when(F.col("success").isNull(), "skip").when(F.col("success"), "pass").otherwise("fail")
    return r.select("rule_id", "severity", outcome.alias("outcome"))


@query("report_of_partition", _SWEEP + f"""SELECT rule_id AS "rule", CASE WHEN success IS NULL THEN 'skip' WHEN success THEN 'ok' ELSE {_SEVERITY} END AS status
FROM r WHERE day = (SELECT max(day) FROM r)""")
def report_of_partition(spark, sf):
    """The newest day's report as text, and from that text the table of all checks."""
    r = sweep_of_events(spark, sf)
    newest = r.agg(F.max("partition")).first()[0]
    text = history.markdown(r.filter(F.col("partition") == newest), f"events {newest}")
    lines = small_table(spark, [{"line": x} for x in text.split("## All checks")[1].splitlines()], pa.schema([("line", pa.string())]))
    cells = F.split("line", r" \| ")
    return lines.filter(r"line LIKE '| %' AND line NOT LIKE '| status |%'").select(
        cells[1].alias("rule"), F.substring(cells[0], 3, 20).alias("status"))


# check results of several datasets and runs, derived from lineitem
_NAMES = ", ".join(f"({k}, '{v}')" for k, v in CATEGORIES.items())
RESULTS = f"""(SELECT 'run-' || (CASE WHEN l_discount > 0.05 THEN 2 ELSE 1 END) AS run_id, 'ds_' || l_returnflag AS dataset,
  strftime(l_shipdate, '%Y-%m') AS partition, c.dim, c.category, c.dim || '.' || l_linestatus || '.' || l_linenumber AS rule_id,
  CASE WHEN l_linenumber <= 4 THEN 'blocking' WHEN l_linenumber <= 6 THEN 'warning' ELSE 'skipped' END AS severity,
  CASE WHEN l_linenumber <= 6 THEN l_quantity > 4 END AS success, CAST(l_quantity AS BIGINT) AS unexpected_count,
  TIMESTAMP '2024-01-01 00:00:00' + CASE WHEN l_discount > 0.05 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS run_at
  FROM lineitem JOIN (VALUES {_NAMES}) c(dim, category) ON c.dim = 1 + l_suppkey % 12) x"""


def derived_results(spark, sf):
    names = small_table(spark, [{"dim": k, "category": v} for k, v in CATEGORIES.items()],
                        pa.schema([("dim", pa.int32()), ("category", pa.string())]))
    li = table(spark, sf, "lineitem").withColumn("dim", (F.lit(1) + F.col("l_suppkey") % 12).cast("int")).join(names, "dim")
    late = F.col("l_discount") > 0.05
    return li.select(
        F.when(late, "run-2").otherwise("run-1").alias("run_id"), F.concat(F.lit("ds_"), "l_returnflag").alias("dataset"),
        F.date_format("l_shipdate", "yyyy-MM").alias("partition"), "dim", "category",
        F.concat_ws(".", F.col("dim").cast("string"), "l_linestatus", F.col("l_linenumber").cast("string")).alias("rule_id"),
        F.expr("CASE WHEN l_linenumber <= 4 THEN 'blocking' WHEN l_linenumber <= 6 THEN 'warning' ELSE 'skipped' END").alias("severity"),
        F.expr("CASE WHEN l_linenumber <= 6 THEN l_quantity > 4 END").alias("success"),
        F.col("l_quantity").cast("bigint").alias("unexpected_count"),
        F.when(late, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("timestamp_ntz").alias("run_at"))


_COUNTS = """CAST(count(*) FILTER (WHERE success) AS BIGINT) AS pass, CAST(count(*) FILTER (WHERE NOT success) AS BIGINT) AS fail,
  CAST(count(*) FILTER (WHERE success IS NULL) AS BIGINT) AS skip, CAST(count(*) FILTER (WHERE NOT success AND severity = 'blocking') AS BIGINT) AS fail_blocking,
  CAST(count(*) FILTER (WHERE NOT success AND severity <> 'blocking') AS BIGINT) AS fail_warning, CAST(count(*) AS BIGINT) AS checks"""


@query("results_summary", f"""SELECT dataset, partition, coalesce(category, '(total)') AS category, {_COUNTS} FROM {RESULTS}
GROUP BY GROUPING SETS ((dataset, partition, category), (dataset, partition))""")
def results_summary(spark, sf):
    return summary.summarise(derived_results(spark, sf)).withColumn("category", F.coalesce("category", F.lit("(total)")))


@query("results_verdicts", f"""SELECT dataset, partition, {_COUNTS}, CASE WHEN count(*) FILTER (WHERE NOT success AND severity = 'blocking') = 0
  THEN 'LAYAK' ELSE 'TIDAK LAYAK' END AS verdict FROM {RESULTS} GROUP BY 1, 2""")
def results_verdicts(spark, sf):
    return summary.verdicts(derived_results(spark, sf))


_SETS = "(VALUES ('bronze', 2), ('bronze', 3), ('bronze', 9), ('bronze', 11), ('bronze', 12), ('silver', 1), ('silver', 4), ('silver', 5), ('silver', 6), ('silver', 8), ('silver', 10), ('gold', 6), ('gold', 7), ('misc', 2), ('misc', 3), ('misc', 9), ('misc', 11), ('misc', 12)) s(layer, dim)"
_MEMBERS = "(VALUES ('bronze', 'ds_A'), ('silver', 'ds_A'), ('silver', 'ds_N'), ('gold', 'ds_R'), ('misc', 'ds_N'), ('gold', 'ds_gone')) g(layer, dataset)"
_LAYERED = f"(SELECT g.layer, x.* FROM {RESULTS} JOIN {_MEMBERS} ON x.dataset = g.dataset JOIN {_SETS} ON s.layer = g.layer AND s.dim = x.dim) y"


def members(spark):
    rows = [("bronze", "ds_A"), ("silver", "ds_A"), ("silver", "ds_N"), ("gold", "ds_R"), ("misc", "ds_N"), ("gold", "ds_gone")]
    return small_table(spark, [{"layer": a, "dataset": b} for a, b in rows], pa.schema([("layer", pa.string()), ("dataset", pa.string())]))


@query("layer_filter", f"SELECT layer, dataset, dim, CAST(count(*) AS BIGINT) AS checks FROM {_LAYERED} GROUP BY 1, 2, 3")
def layer_filter(spark, sf):
    return summary.with_layers(derived_results(spark, sf), members(spark)).groupBy("layer", "dataset", "dim").agg(
        F.count(F.lit(1)).alias("checks"))


@query("layer_filter_one", f"SELECT dataset, category, CAST(count(*) AS BIGINT) AS checks FROM {RESULTS} WHERE dim IN (6, 7) GROUP BY 1, 2")
def layer_filter_one(spark, sf):
    return summary.for_layer(derived_results(spark, sf), "Gold").groupBy("dataset", "category").agg(F.count(F.lit(1)).alias("checks"))


_STATUS = f"""(SELECT g.layer, g.dataset, CAST(count(y.dataset) AS BIGINT) AS checks, CAST(count(*) FILTER (WHERE NOT success AND severity = 'blocking') AS BIGINT) AS fail_blocking,
  CASE WHEN count(*) FILTER (WHERE NOT success AND severity = 'blocking') > 0 THEN 'GAGAL' WHEN count(y.dataset) = 0 THEN 'ERROR' ELSE 'LOLOS' END AS status
  FROM {_MEMBERS} LEFT JOIN {_LAYERED} ON y.layer = g.layer AND y.dataset = g.dataset GROUP BY 1, 2) z"""


@query("dataset_status", f"SELECT layer, dataset, checks, fail_blocking, status FROM {_STATUS}")
def dataset_status(spark, sf):
    layered = summary.with_layers(derived_results(spark, sf), members(spark))
    return summary.dataset_status(layered, members(spark)).select("layer", "dataset", "checks", "fail_blocking", "status")


@query("layer_summary", f"""SELECT layer, coalesce(dataset, '(all)') AS dataset, coalesce(category, '(all)') AS category, {_COUNTS} FROM {_LAYERED}
GROUP BY GROUPING SETS ((layer, dataset, category), (layer, dataset), (layer))""")
def layer_summary(spark, sf):
    """Written as the summary table of the run and read back."""
    s = summary.layer_summary(summary.with_layers(derived_results(spark, sf), members(spark)))
    return materialise(s, "layer_summary").withColumns({c: F.coalesce(c, F.lit("(all)")) for c in ("dataset", "category")})


@query("cross_layer_summary", f"""SELECT CAST(count(*) + 2 AS BIGINT) AS total, CAST(count(*) FILTER (WHERE status = 'LOLOS') AS BIGINT) AS passed,
  CAST(count(*) FILTER (WHERE status = 'GAGAL') + 1 AS BIGINT) AS failed, CAST(count(*) FILTER (WHERE status = 'ERROR') + 1 AS BIGINT) AS errors FROM {_STATUS}""")
def cross_layer_summary(spark, sf):
    """Two expected layers left no summary: one exited with 1, the other with 3."""
    st = summary.dataset_status(summary.with_layers(derived_results(spark, sf), members(spark)), members(spark))
    return summary.cross_layer(st, {"bronze": 0, "silver": 0, "gold": 1, "misc": 0, "lost": 1, "crashed": 3})


@query("run_trend", f"""
WITH t AS (SELECT dataset, partition, rule_id, run_id, run_at, bool_and(success) AS success FROM {RESULTS} GROUP BY 1, 2, 3, 4, 5),
l AS (SELECT *, lag(success) OVER (PARTITION BY dataset, partition, rule_id ORDER BY run_at, run_id) AS before FROM t)
SELECT run_id, dataset, CASE WHEN success IS NULL THEN 'skipped' WHEN NOT success AND coalesce(before, true) THEN 'new' WHEN success AND NOT before THEN 'fixed'
  WHEN NOT success THEN 'persistent' ELSE 'steady' END AS change, CAST(count(*) AS BIGINT) AS rules FROM l GROUP BY 1, 2, 3""")
def run_trend(spark, sf):
    per_run = derived_results(spark, sf).groupBy("dataset", "partition", "rule_id", "run_id", "run_at").agg(F.bool_and("success").alias("success"))
    return summary.trend(per_run).groupBy("run_id", "dataset", "change").agg(F.count(F.lit(1)).alias("rules"))


@query("gate_code", f"""SELECT CAST(max(CASE WHEN NOT success AND severity = 'blocking' THEN 1 ELSE 0 END) AS INTEGER) AS exit_code FROM {RESULTS}
UNION ALL SELECT CAST(max(CASE WHEN status <> 'LOLOS' THEN 1 ELSE 0 END) AS INTEGER) FROM {_STATUS}""")
def gate_code(spark, sf):
    r = derived_results(spark, sf)
    return summary.gate(r).unionByName(summary.layer_gate(summary.dataset_status(summary.with_layers(r, members(spark)), members(spark))))


@query("recent_run", f"""SELECT dataset, run_id, CAST(count(*) AS BIGINT) AS checks FROM {RESULTS} WHERE run_id = 'run-2' GROUP BY 1, 2""")
def recent_run(spark, sf):
    r = summary.recent(derived_results(spark, sf), dt.datetime(2024, 1, 2, 0, 30))
    return r.groupBy("dataset", "run_id").agg(F.count(F.lit(1)).alias("checks"))


@query("top_findings", f"""
WITH f AS (SELECT DISTINCT dataset, severity, dim, rule_id, partition FROM {RESULTS} WHERE NOT success),
p AS (SELECT *, row_number() OVER (PARTITION BY dataset, severity ORDER BY dim, rule_id, partition) AS position, count(*) OVER (PARTITION BY dataset, severity) AS n FROM f)
SELECT dataset, severity, CAST(position AS INTEGER) AS position, dim, rule_id, partition, CAST(greatest(n - 15, 0) AS BIGINT) AS left_out FROM p WHERE position <= 15""")
def top_findings(spark, sf):
    failed = derived_results(spark, sf).filter("NOT success").select("dataset", "severity", "dim", "rule_id", "partition").distinct()
    f = summary.top_findings(failed.withColumns({"success": F.lit(False), "unexpected_count": F.lit(1)}))
    return f.drop("unexpected_count")


@query("result_history", f"""SELECT dataset, run_id, CAST(count(*) AS BIGINT) AS checks FROM {RESULTS} WHERE NOT (dataset = 'ds_A' AND run_id = 'run-1') GROUP BY 1, 2""")
def result_history(spark, sf):
    """Two runs appended; the history of one dataset reset between them."""
    root, r = scratch_path(spark, "history"), derived_results(spark, sf)
    history.append(r.filter("run_id = 'run-1'"), root)
    history.reset(spark, root, dt.datetime(2024, 1, 1, 12), "ds_A")
    history.append(r.filter("run_id = 'run-2'"), root)
    return history.read(spark, root).groupBy("dataset", "run_id").agg(F.count(F.lit(1)).alias("checks"))


@query("result_json_sink", f"""SELECT category, CAST(count(*) AS BIGINT) AS checks, CAST(sum(unexpected_count) AS BIGINT) AS unexpected FROM {RESULTS} GROUP BY 1""")
def result_json_sink(spark, sf):
    path, r = scratch_path(spark, "json"), derived_results(spark, sf)
    history.write_json(r, path)
    return spark.read.schema(r.schema).json(path).groupBy("category").agg(
        F.count(F.lit(1)).alias("checks"), F.sum("unexpected_count").alias("unexpected"))


_PRICES = {"kolom": [{"nama": "o_orderkey", "tipe": "integer"},
                     {"nama": "o_totalprice", "tipe": "float", "rentang": [0, 200000], "profil_distribusi": True}]}
_VALUES = {"kolom": [{"nama": "event_id", "tipe": "integer"}, {"nama": "value", "tipe": "float", "rentang": [0, 100], "profil_distribusi": True},
                     {"nama": "props"}]}


@query("run_many_datasets", """
SELECT 'orders' AS dataset, 'ok' AS outcome, rule_id, CAST(sum(n) AS BIGINT) AS unexpected, CAST(count(*) AS BIGINT) AS partitions FROM (
  SELECT year(o_orderdate), r AS rule_id, count(*) FILTER (WHERE r = '7.physical_range.o_totalprice' AND o_totalprice > 200000) AS n FROM orders,
    (VALUES ('4.not_null.o_orderkey'), ('7.physical_range.o_totalprice')) v(r) GROUP BY ALL) GROUP BY ALL
UNION ALL SELECT 'events', 'ok', rule_id, CAST(sum(n) AS BIGINT), CAST(count(*) AS BIGINT) FROM (
  SELECT CAST(ts AS DATE), r AS rule_id, count(*) FILTER (WHERE r = '7.physical_range.value' AND value > 100) AS n FROM events,
    (VALUES ('4.not_null.event_id'), ('7.physical_range.value')) v(r) GROUP BY ALL) GROUP BY ALL
UNION ALL SELECT d, 'error', '-', 0, 0 FROM (VALUES ('missing'), ('raising'), ('hanging')) v(d)""")
def run_many_datasets(spark, sf):
    """Two datasets are validated at the same time as one that can't be planned, one that fails while it runs, and one over its limit."""
    def checked(name, spec, frame, part):
        def run():
            df, c = with_partition(frame(), part), parse_contract(name, spec)
            return ev.evaluate(df, c, bl.learn(df, c, now=NOW), now=NOW, run_id="run-1").filter(
                F.col("rule_id").isin("4.not_null.o_orderkey", "4.not_null.event_id") | (F.col("rule_kind") == "physical_range"))
        return run

    def asleep(batches):
        for b in batches:
            time.sleep(600)
            yield b

    events = lambda: table(spark, sf, "events")
    day = F.to_date("ts")
    done, failed = history.run_all(spark, {
        "orders": checked("orders", _PRICES, lambda: table(spark, sf, "orders"), F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1))),
        "missing": checked("missing", _VALUES, lambda: table(spark, sf, "no_such_table"), day),
        "raising": checked("raising", _VALUES, lambda: events().withColumn("value", F.col("event_type").cast("double")), day),
        "hanging": checked("hanging", _VALUES, lambda: events().mapInArrow(asleep, events().schema), day),
        "events": checked("events", _VALUES, events, day)}, limits={"hanging": 4.0}, parallel=5)
    return done.groupBy("dataset", F.lit("ok").alias("outcome"), "rule_id").agg(
        F.sum("unexpected_count").alias("unexpected"), F.count("*").alias("partitions")).unionByName(
        failed.select("dataset", F.lit("error").alias("outcome"), F.lit("-").alias("rule_id"), F.lit(0).cast("bigint").alias("unexpected"),
                      F.lit(0).cast("bigint").alias("partitions")))


@query("sweep_sinks", f"""
WITH r AS (SELECT dataset, run_id, partition, severity, success FROM {RESULTS}),
v AS (SELECT run_id, dataset, CAST(count(DISTINCT partition) AS BIGINT) AS partitions FROM r GROUP BY ALL),
f AS (SELECT run_id, dataset, CAST(count(*) AS BIGINT) AS failures FROM r WHERE NOT success AND severity = 'blocking' AND run_id <> 'run-1' GROUP BY ALL)
SELECT run_id, dataset, partitions, coalesce(failures, 0) AS failures FROM v LEFT JOIN f USING (run_id, dataset)""")
def sweep_sinks(spark, sf):
    """Two runs are committed, the first one once more without its failures, which replaces it; a run without manifest stays unseen."""
    none = lambda t: F.lit(None).cast(t)
    root, r = scratch_path(spark, "sinks"), derived_results(spark, sf).withColumns({
        "part_date": F.to_date("partition", "yyyy-MM"), "observed_num": none("double"), "observed_text": none("string"),
        "sample": none("array<string>"), "error": none("string")})
    for run in ("run-1", "run-2"):
        history.append_sweep(r.filter(F.col("run_id") == run), root)
    history.append_sweep(r.filter("run_id = 'run-1'").withColumn("success", F.col("success") | F.lit(True)), root)
    stopped, by = r.filter("run_id = 'run-2'").withColumn("run_id", F.lit("run-3")), ("run_id",)
    for name, made in (("sweep_verdicts", summary.sweep(stopped, by)), ("sweep_failures", summary.blocking_failures(stopped, by=by))):
        made.write.parquet(f"{root}/{name}/data/commit=stopped")
    verdicts, failures = history.read_sweep(spark, root)
    n = failures.groupBy("run_id", "dataset").agg(F.count("*").alias("failures"))
    return verdicts.groupBy("run_id", "dataset").agg(F.count_distinct("partition").alias("partitions")).join(
        n, ["run_id", "dataset"], "left").withColumn("failures", F.coalesce("failures", F.lit(0)))


@query("layer_summary_sink", f"""
SELECT d AS run_date, layer, coalesce(dataset, '(all)') AS dataset, coalesce(category, '(all)') AS category, {_COUNTS}
FROM {_LAYERED}, (VALUES ('2024-02-01'), ('2024-02-02')) v(d) WHERE d = '2024-02-01' OR run_id = 'run-2'
GROUP BY GROUPING SETS ((d, layer, dataset, category), (d, layer, dataset), (d, layer))""")
def layer_summary_sink(spark, sf):
    """Summaries of two days; the second day is run again with one run only, which replaces it."""
    root, layered = scratch_path(spark, "layers"), summary.with_layers(derived_results(spark, sf), members(spark))
    for day, rows in (("2024-02-01", layered), ("2024-02-02", layered), ("2024-02-02", layered.filter("run_id = 'run-2'"))):
        history.append_layer_summary(rows, root, day)
    return history.read_layer_summary(spark, root).withColumns({
        "run_date": F.col("run_date").cast("string"), **{c: F.coalesce(c, F.lit("(all)")) for c in ("dataset", "category")}})
