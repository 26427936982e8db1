"""Evaluate a contract and a baseline on every partition of a frame at once.

The compiled rules fall into a few families, and each family is one distributed job over all
partitions: row rules and scalar metrics (grouped passes), keys, memberships, order statistics,
z-scores. Validating one partition is the same job behind a partition filter.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.contract import Contract
from lakegauge.functions import numbers, text, times
from lakegauge.operators import distribution, keys, membership, onepass, order_stats, predicates, reconcile, rules, schema
from lakegauge.operators.prepare import PART, PART_DATE, expected_column, number_column, prepare
from lakegauge.plans.baseline import QS, Baseline
from lakegauge.plans.catalog import BLOCKING, CATEGORIES, SKIPPED, WARNING
from lakegauge.session import materialise, small_table

GROUP = [PART, PART_DATE]
# columns of these types reach the rules as they are in the frame
_AS_THEY_ARE = (T.StringType, T.IntegralType, T.BooleanType)
# text columns whose history has at most this many values are tested once per value
FEW_VALUES = 10_000
_FIELDS = {"rule_id": "string", "success": "boolean", "element_count": "bigint", "missing_count": "bigint",
           "unexpected_count": "bigint", "unexpected_percent": "double", "observed_num": "double",
           "observed_text": "string", "error": "string"}
_META = pa.schema([("rule_id", pa.string()), ("dim", pa.int32()), ("category", pa.string()), ("rule_kind", pa.string()),
                   ("column", pa.string()), ("severity", pa.string()), ("lo", pa.float64()), ("hi", pa.float64()),
                   ("note", pa.string())])


@dataclass
class Plan:
    """Rules of one dataset, compiled against the columns that are really there."""

    meta: dict[str, dict] = field(default_factory=dict)
    row_rules: list[rules.RowRule] = field(default_factory=list)
    predicates: list[rules.RowRule] = field(default_factory=list)   # may raise errors of their own
    metrics: dict[str, Column] = field(default_factory=dict)
    metric_of: dict[str, str] = field(default_factory=dict)     # metric or rule count -> column it reads
    verdicts: list[dict] = field(default_factory=list)          # over the metrics table
    constants: list[dict] = field(default_factory=list)         # same answer for every partition
    unique: dict[str, list[str]] = field(default_factory=dict)
    surplus: dict[str, tuple[list[str], int]] = field(default_factory=dict)
    codes: dict[str, str] = field(default_factory=dict)          # column -> rule id
    pairs: dict[str, str] = field(default_factory=dict)          # relation -> rule id
    sets: dict[str, str] = field(default_factory=dict)
    quantiles: dict[str, tuple[str, dict]] = field(default_factory=dict)
    medians: dict[str, str] = field(default_factory=dict)
    z_rules: dict[str, str] = field(default_factory=dict)
    entity: str | None = None

    def rule(self, dim: int, kind: str, column: str | None, severity: str = BLOCKING, lo=None, hi=None,
             note: str | None = None) -> str:
        rid = f"{dim}.{kind}" + (f".{column}" if column else "")
        n = 2
        while rid in self.meta:
            rid, n = f"{dim}.{kind}.{column}#{n}", n + 1
        self.meta[rid] = {"rule_id": rid, "dim": dim, "category": CATEGORIES[dim], "rule_kind": kind, "column": column,
                          "severity": severity, "lo": None if lo is None else float(lo),
                          "hi": None if hi is None else float(hi), "note": note}
        return rid

    def skip(self, dim: int, kind: str, reason: str, column: str | None = None) -> None:
        self.constants.append({"rule_id": self.rule(dim, kind, column, SKIPPED, note=reason), "success": None})

    def measure(self, column: str, **metrics: Column) -> None:
        self.metrics.update(metrics)
        self.metric_of.update(dict.fromkeys(metrics, column))

    @staticmethod
    def rule_column(row_rules: list[rules.RowRule], name: str) -> str:
        """Column behind a shared count of tested rows, named by the order of first use."""
        keys_seen = list(dict.fromkeys(r.tested_key for r in row_rules))
        if not name.startswith("_t"):
            return ""
        key = keys_seen[int(name[2:]) - 1]
        return next(r.columns[0] for r in row_rules if r.tested_key == key)

    def answer(self, rid: str, success: bool, observed: str | None = None, error: str | None = None) -> None:
        self.constants.append({"rule_id": rid, "success": success, "observed_text": observed, "error": error})

    def verdict(self, rid: str, success: Column, observed: Column | None = None, **counts: Column) -> None:
        self.verdicts.append({"rule_id": rid, "success": success, "observed_num": observed, **counts})


def _family(t: T.DataType) -> str:
    if numbers.is_numeric(t):
        return "number"
    if numbers.is_temporal(t):
        return "time"
    return t.typeName()


class Compiler:
    """Turns contract and baseline into a Plan; a rule whose column is absent or of the wrong kind fails with an error."""

    def __init__(self, c: Contract, base: Baseline, raw: DataFrame, prepared: DataFrame, now: dt.datetime, mode: str,
                 window_days: int, offset_hours: float):
        self.c, self.b, self.now, self.mode = c, base, now, mode
        self.raw_types = {f.name: f.dataType for f in raw.schema if f.name not in GROUP}
        self.frame, self.types = prepared, {f.name: f.dataType for f in prepared.schema}
        self.window_days, self.offset_hours = window_days, offset_hours
        self.p = Plan()

    def usable(self, rid: str, *columns: str, family: str | None = None) -> bool:
        for n in columns:
            if n not in self.types:
                self.p.answer(rid, False, error=f"column {n} does not exist")
                return False
            if family and _family(self.types[n]) != family:
                self.p.answer(rid, False, error=f"column {n} is {self.types[n].simpleString()}, expected {family}")
                return False
        return True

    def row(self, rule: rules.RowRule) -> None:
        self.p.row_rules.append(rule)

    def compile(self) -> Plan:
        for step in (self.schema, self.volume, self.freshness, self.missingness, self.uniqueness, self.integrity,
                     self.distribution, self.cleanliness, self.formats, self.lineage, self.declared):
            step()
        return self.p

    def schema(self) -> None:
        c, p = self.c, self.p
        have = list(self.raw_types)
        p.answer(p.rule(1, "column_count", None, lo=len(c.columns), hi=len(c.columns)), len(have) == len(c.columns),
                 str(len(have)))
        lost, extra = sorted(set(c.column_names) - set(have)), sorted(set(have) - set(c.column_names))
        p.answer(p.rule(1, "column_set", None), not lost and not extra, f"missing {lost}, unexpected {extra}")
        for k in c.columns:
            rid = p.rule(1, "type", k.name, note=k.kind)
            if k.name in self.raw_types:
                t = self.raw_types[k.name]
                p.answer(rid, schema.logical_kind(t) == k.kind, t.simpleString())
            else:
                p.answer(rid, False, error=f"column {k.name} does not exist")

    def volume(self) -> None:
        c, p, v = self.c, self.p, self.b.volume
        rows = F.col("rows")
        p.verdict(p.rule(2, "not_empty", None, lo=1), rows >= 1, rows)
        p.verdict(p.rule(2, "row_corridor", None, lo=v["rows_low"], hi=v["rows_high"]),
                  rows.between(v["rows_low"], v["rows_high"]), rows)
        key = c.business_key[0] if c.business_key else None
        if key and key in self.types:
            p.entity = key
            if v.get("periods"):
                cap = F.col("_entities") * v["periods"]
                p.verdict(p.rule(2, "capacity", key, note=f"{v['periods']} periods per {key}"),
                          rows.between(F.lit(1), cap), rows)
            if v.get("entities_min") is not None:
                p.verdict(p.rule(2, "entity_corridor", key, lo=v["entities_min"], hi=v["entities_max"]),
                          F.col("_entities").between(v["entities_min"], v["entities_max"]), F.col("_entities"))

    def freshness(self) -> None:
        c, p, ev = self.c, self.p, self.c.event_time
        if not ev:
            p.skip(3, "freshness", "the contract declares no event time")
            return
        if not self.usable(p.rule(3, "event_time", ev), ev, family="time"):
            return
        p.meta.pop(f"3.event_time.{ev}")
        part = F.col(PART_DATE)
        start = times.window_start(part, self.offset_hours)
        end = times.window_end(start, self.window_days)
        rid = p.rule(3, "in_window", ev, note="skipped where the partition has no date")
        self.row(rules.in_window(rid, ev, part, self.window_days, self.offset_hours))
        p.measure(ev, max_event=F.max(ev))
        rid = p.rule(3, "reaches_end", ev, WARNING, note="skipped where the partition has no date")
        reach = start + F.expr(f"INTERVAL {self.window_days} DAYS") - F.expr("INTERVAL 4 HOURS")
        p.verdict(rid, F.when(part.isNotNull(), F.coalesce(F.col("max_event").between(reach, end), F.lit(True))), None,
                  observed_text=F.col("max_event").cast("string"))
        self.row(rules.between(p.rule(3, "not_future", ev), ev, hi=_instant(self.now)))
        periods = self.b.volume.get("periods")
        if "_period" in self.types:
            if periods:
                p.measure(ev, periods=times.distinct_periods(F.col("_period")))
                p.verdict(p.rule(3, "all_periods", ev, WARNING, lo=periods, hi=periods),
                          F.coalesce(F.col("periods"), F.lit(0)) == periods, F.col("periods"))
            self.row(rules.off_grid(p.rule(3, "on_grid", ev, WARNING), ev, c.grain))
        if "_lag_days" in self.types:
            sla = c.lag_days.get(self.mode, 2.0)
            sev = BLOCKING if self.mode == "harian" else WARNING
            self.row(rules.lag_within(p.rule(3, "lag", c.load_time, sev, 0, sla), ev, c.load_time, sla))

    def missingness(self) -> None:
        c, p = self.c, self.p
        for k in c.columns:
            if k.required:
                rid = p.rule(4, "not_null", k.name)
                if self.usable(rid, k.name):
                    self.row(rules.not_null(rid, k.name))
            elif k.name in self.b.missing:
                floor = self.b.missing[k.name]["min_present"]
                rid = p.rule(4, "present_share", k.name, lo=floor, hi=1.0)
                if self.usable(rid, k.name):
                    m = f"present__{k.name}"
                    p.measure(k.name, **{m: F.count(k.name)})
                    share = F.try_divide(F.col(m).cast("double"), F.col("rows"))
                    p.verdict(rid, F.coalesce(share >= floor, F.lit(True)), share, element_count=F.col("rows"),
                              missing_count=F.col("rows") - F.col(m))
        for n in c.text_columns:
            rid = p.rule(4, "not_empty_text", n, lo=1)
            if self.usable(rid, n, family="string"):
                self.row(rules.length_between(rid, n, 1))

    def uniqueness(self) -> None:
        c, p = self.c, self.p
        if not (c.surrogate_key or c.business_key or c.flags):
            p.skip(5, "uniqueness", "the contract declares no key")
            return
        if c.surrogate_key:
            rid = p.rule(5, "surrogate_unique", c.surrogate_key)
            if self.usable(rid, c.surrogate_key):
                p.unique[rid] = [c.surrogate_key]
        if c.business_key:
            rid = p.rule(5, "business_unique", "+".join(c.business_key))
            if self.usable(rid, *c.business_key):
                p.unique[rid] = list(c.business_key)
                if "_period_floor" in self.types and c.event_time in c.business_key:
                    key = [k for k in c.business_key if k != c.event_time] + ["_period_floor"]
                    p.unique[p.rule(5, "one_per_period", "+".join(key), WARNING)] = key
        for f in c.flags:
            if f.get("flag") and f.get("harus") is not None:
                rid = p.rule(5, "flag_constant", f["flag"], f.get("severity", BLOCKING), note=f.get("catatan"))
                fam = "boolean" if isinstance(f["harus"], bool) else None
                if self.usable(rid, f["flag"], family=fam):
                    self.row(rules.constant(rid, f["flag"], f["harus"]))

    def integrity(self) -> None:
        c, p = self.c, self.p
        if not (c.reference_columns or c.relations or c.equal_pairs or c.ordered_pairs or c.flags):
            p.skip(6, "integrity", "the contract declares no relation between data")
            return
        for n in c.reference_columns:
            size = self.b.master_sizes.get(n)
            if size:
                rid = p.rule(6, "in_master", n, note=f"{size} known codes")
                if self.usable(rid, n):
                    p.codes[n] = rid
        for a, b in c.relations:
            rel = f"{a}->{b}"
            if self.b.relation_sizes.get(rel):
                rid = p.rule(6, "relation", rel)
                if self.usable(rid, a, b):
                    p.pairs[rel] = rid
        for kind, build, pairs in (("equal", rules.equal, c.equal_pairs), ("ordered", rules.at_least, c.ordered_pairs)):
            for a, b in pairs:
                rid = p.rule(6, kind, f"{a},{b}")
                if self.usable(rid, a, b) and self.usable(rid, b, family=_family(self.types[a])):
                    self.row(build(rid, a, b))
        for f in c.flags:
            if f.get("flag") and f.get("kolom") and f.get("aturan"):
                rid = p.rule(6, "flag_agrees", f["flag"])
                if self.usable(rid, f["flag"], family="boolean") and self.usable(rid, expected_column(f["flag"])):
                    self.row(rules.flag_agrees(rid, f["flag"], f["kolom"], F.col(expected_column(f["flag"]))))

    def distribution(self) -> None:
        c, p, t = self.c, self.p, self.c.thresholds
        if not self.b.distribution:
            p.skip(7, "distribution", "no profiled numeric column")
        for k in c.profiled_columns:
            d = self.b.distribution.get(k.name)
            if not d:
                if self.b.distribution:
                    p.skip(7, "distribution", "not numeric, or without values in the history", k.name)
                continue
            x = number_column(k.name)
            rid = p.rule(7, "mean_corridor", k.name, lo=d["mean_low"], hi=d["mean_high"])
            if not self.usable(rid, x):
                continue
            if k.bounds:
                self.row(rules.between(p.rule(7, "physical_range", k.name, lo=k.bounds[0], hi=k.bounds[1]), x, *k.bounds))
            v = F.col(x)
            p.measure(k.name, **{f"{k.name}__n": F.count(v), f"{k.name}__mean": F.avg(v), f"{k.name}__sd": F.stddev_samp(v),
                                 f"{k.name}__min": F.min(v), f"{k.name}__max": F.max(v)})
            n, mean, sd = (F.col(f"{k.name}__{s}") for s in ("n", "mean", "sd"))
            p.verdict(rid, F.coalesce(mean.between(d["mean_low"], d["mean_high"]), F.lit(True)), mean, element_count=n)
            p.verdict(p.rule(7, "stdev_corridor", k.name, lo=0, hi=d["sd_high"], note="a single row has no deviation and passes"),
                      F.coalesce(sd.between(0.0, d["sd_high"]), F.lit(True)), sd, element_count=n)
            if d["zero_min"] > 0.5:
                p.medians[k.name] = p.rule(7, "median_zero", k.name, lo=0, hi=0)
            if d["quantile_corridor"]:
                p.quantiles[k.name] = (p.rule(7, "quantile_shape", k.name), d["quantile_corridor"])
            counts = distribution.bin_counts(v, d["bins"], f"{k.name}__bin")
            p.measure(k.name, **counts)
            kl = distribution.divergence([F.col(f"`{m}`") for m in counts], d["weights"])
            p.verdict(p.rule(7, "kl_divergence", k.name, hi=t["batas_kl"]),
                      F.coalesce(kl <= t["batas_kl"], F.lit(True)), kl, element_count=n)
            p.z_rules[k.name] = p.rule(7, "z_score", k.name, WARNING, hi=t["batas_zscore"])
        for n in c.reference_columns:
            if 1 < self.b.master_sizes.get(n, 0) <= 10 and n in self.types:
                p.sets[n] = p.rule(7, "same_set", n, WARNING)

    def cleanliness(self) -> None:
        c, p = self.c, self.p
        if not c.text_columns:
            p.skip(8, "cleanliness", "the contract has no text column")
            return
        for n in c.text_columns:
            known, k = self.b.text.get(n), c.column(n)
            if known:
                rid = p.rule(8, "pattern", n, note=" | ".join(known["patterns"]))
                if self.usable(rid, n, family="string"):
                    self.row(rules.matches_any(rid, n, known["patterns"]))
                lo, hi = k.length or (known["len_min"], known["len_max"])
                rid = p.rule(8, "length", n, lo=lo, hi=hi)
                if self.usable(rid, n, family="string"):
                    self.row(rules.length_between(rid, n, lo, hi))
            for kind, pattern, severity in text.DIRTY_TEXT:
                rid = p.rule(8, f"no_{kind}", n, severity)
                if self.usable(rid, n, family="string"):
                    self.row(rules.free_of(rid, n, pattern))
            if k.reference:
                rid = p.rule(8, "ascii", n)
                if self.usable(rid, n, family="string"):
                    self.row(rules.matches_any(rid, n, [text.PRINTABLE_ASCII]))

    def formats(self) -> None:
        p = self.p
        cols = [k for k in self.c.columns if k.formats]
        if not cols:
            p.skip(10, "format", "no column declares a format")
        for k in cols:
            rid = p.rule(10, "format", k.name, note=" | ".join(k.formats))
            if self.usable(rid, k.name, family="string"):
                self.row(rules.matches_any(rid, k.name, k.formats))

    def lineage(self) -> None:
        p, audit = self.p, self.c.audit_columns
        if not audit:
            p.skip(12, "lineage", "no audit column is declared")
            return
        lost = [a for a in audit if a not in self.raw_types]
        p.answer(p.rule(12, "audit_columns", None, note=", ".join(audit)), not lost, f"missing {lost}" if lost else None)
        for a in audit:
            if a in self.raw_types:
                self.row(rules.not_null(p.rule(12, "audit_not_null", a), a))

    def declared(self) -> None:
        """Rules the shipped contracts declare in their extra blocks."""
        c, p = self.c, self.p
        for k in c.columns:
            allowed = k.allowed or c.expected_values.get(k.name)
            if allowed:
                rid = p.rule(6, "allowed_values", k.name)
                if self.usable(rid, k.name):
                    self.row(rules.in_set(rid, k.name, allowed))
        for n, limit in c.null_limits.items():
            rid = p.rule(4, "null_limit", n, hi=limit)
            if self.usable(rid, n):
                p.measure(n, **{f"nonnull__{n}": F.count(n)})
                share = 1 - F.try_divide(F.col(f"nonnull__{n}").cast("double"), F.col("rows"))
                p.verdict(rid, F.coalesce(share <= limit, F.lit(True)), share)
        for d in c.duplicate_limits:
            rid = p.rule(5, "duplicate_limit", "+".join(d["columns"]), hi=d["threshold"])
            if self.usable(rid, *d["columns"]):
                p.surplus[rid] = (d["columns"], d["threshold"])
        for q in c.predicates:
            rid = p.rule(6, "predicate", q["name"], note=q["expression"])
            try:
                self.frame.select(F.expr(q["expression"]).cast("boolean"))
            except (AnalysisException, ParseException) as wrong:
                p.answer(rid, False, error=str(wrong).splitlines()[0][:500])
                continue
            p.predicates.append(rules.predicate(rid, q["expression"], q["null_passes"]))
        for n, share in c.expected_ratios.items():
            rid = p.rule(7, "expected_ratio", n, lo=share - c.ratio_tolerance, hi=share + c.ratio_tolerance)
            if self.usable(rid, n, family="boolean"):
                p.measure(n, **{f"ratio__{n}": F.avg(F.col(n).cast("int"))})
                seen = F.col(f"ratio__{n}")
                p.verdict(rid, F.coalesce(F.abs(seen - share) <= c.ratio_tolerance, F.lit(True)), seen)


def _instant(t: dt.datetime) -> Column:
    if t.tzinfo:
        t = t.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def _shape(df: DataFrame) -> DataFrame:
    """Any family's output in the common columns."""
    have = set(df.columns)
    return df.select(*GROUP, *[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in _FIELDS.items()])


def _rows(df: DataFrame, items: list[dict]) -> DataFrame:
    """One output row per item and input row. Fields that differ per row are columns, the rest one JSON literal."""
    varying = {(i, n): v for i, it in enumerate(items) for n, v in it.items() if isinstance(v, Column)}
    fixed = json.dumps([{n: v for n, v in it.items() if not isinstance(v, Column)} for it in items], default=str)
    schema = ", ".join(f"{n} {t}" for n, t in _FIELDS.items())
    base = F.from_json(F.lit(fixed), f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
    if not varying:
        return df.select(*GROUP, F.inline(base)).select(*GROUP, *_FIELDS)
    cols = [v.cast(_FIELDS[n]).alias(f"_{n}_{i}") for (i, n), v in varying.items()]
    names = sorted({n for _, n in varying})
    structs = ", ".join("struct(" + ", ".join(
        (f"_{n}_{i}" if (i, n) in varying else f"CAST(NULL AS {_FIELDS[n]})") + f" AS _v_{n}" for n in names) + ")"
        for i in range(len(items)))
    out = df.select(*GROUP, *cols).select(*GROUP, F.expr(f"posexplode(array({structs})) AS (_i, _v)"))
    out = out.withColumn("_f", F.element_at(base, F.col("_i") + 1))
    return out.select(*GROUP, *[(F.coalesce(F.col(f"_v._v_{n}"), F.col(f"_f.{n}")) if n in names else F.col(f"_f.{n}")).alias(n)
                                for n in _FIELDS])


def _named(df: DataFrame, by: str, ids: dict[str, str]) -> DataFrame:
    """Replace a column or relation name by its rule id."""
    lookup = F.create_map(*[F.lit(x) for kv in ids.items() for x in kv])
    return df.filter(F.col(by).isin(*ids)).withColumn("rule_id", lookup[F.col(by)])


def metrics_table(frame: DataFrame, p: Plan, rule_aggs: dict[str, Column], entities: DataFrame | None = None) -> DataFrame:
    """Scalar metrics and row-rule counts per partition, in as few passes as whole-stage codegen allows.

    Aggregates are laid out by the column they read, so all passes together scan each column about
    once; the pass results meet at one row per partition. ``entities`` (partition, _entities) spares their count.
    """
    items = [("", "rows", F.count(F.lit(1)))]
    items += [(p.metric_of.get(n, n), n, m) for n, m in p.metrics.items()]
    items += [(p.metric_of.get(n, n), n, m) for n, m in rule_aggs.items()]
    items.sort(key=lambda x: x[0])
    out, room, batch = None, 0, {}
    batches = []
    for _, name, m in items:
        need = 3 if name.endswith(("__mean", "__sd")) else 1
        if need > room:
            batch, room = {}, onepass.SLOTS_PER_PASS
            batches.append(batch)
        batch[name] = m
        room -= need
    for b in batches:
        part = onepass.grouped_metrics(frame, GROUP, b)
        out = part if out is None else _join_parts(out, part)
    if p.entity:
        out = _join_parts(out, keys.distinct_count(frame, GROUP, p.entity, "_entities") if entities is None else entities)
    return out


def _join_parts(a: DataFrame, b: DataFrame) -> DataFrame:
    b = b.drop(PART_DATE).withColumnRenamed(PART, "_p2")
    return a.join(b, a[PART].eqNullSafe(F.col("_p2")), "left").drop("_p2")


def evaluate(frame: DataFrame, c: Contract, base: Baseline, *, now: dt.datetime, mode: str = "backfill",
             partitions: DataFrame | None = None, unreadable: DataFrame | None = None,
             source: DataFrame | reconcile.SourceCounts | None = None, source_reason: str | None = None,
             masters: dict[str, DataFrame] | None = None, samples: int = 0, window_days: int = 1, offset_hours: float = 0.0,
             run_id: str | None = None, states: dict[str, DataFrame] | None = None) -> DataFrame:
    """check_results of every partition of ``frame`` (which carries its partition columns).

    ``partitions`` (part, part_date, label, bytes, files) makes empty partitions visible and
    enables the size rule; ``unreadable`` (part, part_date, error) turns broken files into
    findings; ``source`` is the relation behind the landed table, or its counts; ``masters`` holds the official
    master tables that the contract's links name. ``states`` are what ``baseline.gather`` remembers of the partitions of this
    very frame; counted values and entities that they hold are not counted again.
    """
    spark = frame.sparkSession
    work = prepare(frame, c)
    compiler = Compiler(c, base, frame, work, now, mode, window_days, offset_hours)
    p = compiler.compile()

    links = {}
    for link in c.master_links:
        target = f"{link['table']}.{link['key']}"
        master = (masters or {}).get(link["table"])
        if master is None:
            p.skip(6, "master_table", f"no table given for {target}", link["column"])
        else:
            rid = p.rule(6, "master_table", link["column"], note=target)
            if compiler.usable(rid, link["column"]):
                links[rid] = (link["column"], master, link["key"])

    few = {n for n, t in base.text.items() if t["distinct_values"] <= FEW_VALUES and n in compiler.types
           and isinstance(compiler.types[n], T.StringType)}
    by_value = [r for r in p.row_rules if len(r.columns) == 1 and r.columns[0] in few and r.skip == "any"]
    ids = {r.rule_id for r in by_value}
    by_row = [r for r in p.row_rules if r.rule_id not in ids]
    rule_aggs, rule_rows = onepass.rule_counts(by_row)
    for i, r in enumerate(by_row):
        p.metric_of[f"_b{i}"] = r.columns[0] if r.columns else ""
    for n in rule_aggs:
        p.metric_of.setdefault(n, p.rule_column(by_row, n))

    same = {n for n, t in compiler.raw_types.items() if isinstance(t, _AS_THEY_ARE) and n not in (c.event_time, c.load_time)}
    entities = states["parts"].select(PART, F.col("entities").alias("_entities")) if states and p.entity in same else None
    m = metrics_table(work, p, rule_aggs, entities)
    if partitions is not None:
        known = partitions.select(F.col("part").alias("_p2"), F.col("part_date").alias("_d2"), "label", "bytes", "files")
        if unreadable is not None:
            known = known.join(unreadable.select(F.col("part").alias("_p2")), "_p2", "left_anti")
        m = known.join(m, m[PART] == F.col("_p2"), "left").drop(PART, PART_DATE).withColumnsRenamed(
            {"_p2": PART, "_d2": PART_DATE}).withColumn("rows", F.coalesce("rows", F.lit(0)))
        if p.entity:
            m = m.withColumn("_entities", F.coalesce("_entities", F.lit(0)))
    if c.size_bounds is None:
        p.skip(11, "size", "the contract declares no size range")
    elif partitions is None:
        p.skip(11, "size", "the size of the partition is not known")
    else:
        lo, hi = c.size_bounds
        p.verdict(p.rule(11, "size", None, lo=lo, hi=hi), F.col("bytes").between(lo, hi),
                  F.col("bytes"), observed_text=numbers.bytes_text(F.col("bytes")))
    if source is None:
        p.skip(9, "reconcile", source_reason or ("reconciliation is switched off" if c.source_table
                                                 else "the contract declares no source table"))
    else:
        counted = source if isinstance(source, reconcile.SourceCounts) else reconcile.count_source(
            source, c.source_time, c.source_offset_hours)
        lost = [n for n in counted.columns if n not in compiler.raw_types]
        p.answer(p.rule(9, "source_columns", None), not lost, f"missing {lost}" if lost else None)
        rid = p.rule(9, "row_count", c.source_table)
        if counted.days is None:
            m = m.withColumn("_src", F.lit(counted.total).cast("bigint"))
        else:
            # a partition without a date is compared with the whole table
            src = counted.days.select(F.col("day").alias("_sd"), F.col("source_rows").alias("_src"))
            m = m.join(src, m[PART_DATE] == F.col("_sd"), "left").drop("_sd").withColumn(
                "_src", F.when(F.col(PART_DATE).isNull(), F.lit(counted.total)).otherwise(F.coalesce("_src", F.lit(0))))
        p.verdict(rid, F.col("rows") == F.col("_src"), F.col("rows"),
                  observed_text=F.concat(F.lit("source "), F.col("_src").cast("string")))
    m = materialise(m, "metrics")

    out = [_rows(m, p.verdicts), _rows(m, p.constants)]
    held = m.filter("rows > 0")
    if by_row:
        checks = rule_rows(held.select(*GROUP, *rule_aggs))
        undated = [r for r, k in p.meta.items() if k["rule_kind"] == "in_window"]
        ok = F.when(F.col("rule_id").isin(*undated) & F.col(PART_DATE).isNull(), F.lit(None)).otherwise(F.col("success"))
        out.append(_shape(checks.withColumn("success", ok)))
    folded = sorted({r.columns[0] for r in by_value} | {*p.codes, *p.sets})
    if folded:
        # one scan of the code columns serves the text rules, the master lists and the value sets
        if states and same.issuperset(folded) and {*c.text_columns, *c.reference_columns}.issuperset(folded):
            counts = order_stats.same_group(states["codes"].filter(F.col("column").isin(*folded)), m.select(*GROUP), [PART])
        else:
            counts = materialise(onepass.value_counts(work, GROUP, folded), "value_counts")
        if by_value:
            out.append(_shape(onepass.checks_on_values(counts, GROUP, by_value)))
        if p.codes:
            codes = counts.filter(F.col("column").isin(*p.codes))
            out.append(_shape(_named(membership.against_master(codes, GROUP, base.master), "column", p.codes)))
        if p.sets:
            sets = counts.filter(F.col("column").isin(*p.sets))
            s = _named(membership.same_set(sets, GROUP, base.master), "column", p.sets)
            out.append(_shape(s.withColumn("observed_num", (F.col("known_values") + F.col("unknown_values")).cast("double"))))
    if p.predicates:
        out.append(_shape(predicates.isolated(work, GROUP, p.predicates, held.select(*GROUP))))
    for rid, key in p.unique.items():
        out.append(_shape(keys.uniqueness(work, GROUP, key, rid)))
    for rid, (key, limit) in p.surplus.items():
        d = keys.duplicate_rows(work, GROUP, key, limit)
        out.append(_shape(d.withColumn("rule_id", F.lit(rid)).withColumn("unexpected_count", F.col("surplus_rows"))))
    for rid, (col, master, key) in links.items():
        out.append(_shape(membership.referential(work, GROUP, col, master, key).withColumn("rule_id", F.lit(rid))))
    if p.pairs:
        counts = membership.pair_counts(work, GROUP, [tuple(r.split("->")) for r in p.pairs])
        out.append(_shape(_named(membership.pairs_against(counts, GROUP, base.relations), "relation", p.pairs)))
    if p.quantiles or p.medians:
        out += _order_rules(work, held, p, states)
    if p.z_rules:
        out += _z_rules(work, held, p, c.thresholds["batas_zscore"])

    answered = out[0]
    for o in out[1:]:
        answered = answered.unionByName(o)
    scalar = {v["rule_id"] for v in (*p.verdicts, *p.constants)}
    vacuous = [{"rule_id": r, "success": True, "element_count": 0, "missing_count": 0, "unexpected_count": 0}
               for r in p.meta if r not in scalar]
    if partitions is not None and vacuous:
        answered = answered.unionByName(_rows(m.filter("rows = 0"), vacuous))
    if unreadable is not None:
        rid = p.rule(11, "readable", None, note="no other rule can run on this partition")
        u = unreadable.withColumnsRenamed({"part": PART, "part_date": PART_DATE})
        answered = answered.unionByName(_rows(u, [{"rule_id": rid, "success": False, "error": F.col("error")}]))

    meta = small_table(spark, list(p.meta.values()), _META)
    res = answered.join(meta, "rule_id")
    # a rule that does not apply to a partition is a skip there, whatever its severity elsewhere
    res = res.withColumn("severity", F.when(F.col("success").isNull(), SKIPPED).otherwise(F.col("severity")))
    if samples:
        failing = [r for r in p.row_rules if r.skip != "never"]
        smp = onepass.samples(work, GROUP, failing, samples).select(F.col(PART).alias("_p2"), F.col("rule_id").alias("_r2"), "sample")
        res = res.join(smp, F.col(PART).eqNullSafe(F.col("_p2")) & (F.col("rule_id") == F.col("_r2")), "left")
    else:
        res = res.withColumn("sample", F.lit(None).cast("array<string>"))
    if partitions is not None:
        res = res.join(partitions.select(F.col("part").alias("_p3"), F.col("label").alias("_label")),
                       F.col(PART).eqNullSafe(F.col("_p3")), "left")
    else:
        res = res.withColumn("_label", F.col(PART))
    return _results(res, c, run_id or uuid.uuid4().hex, now)


def _results(res: DataFrame, c: Contract, run_id: str, now: dt.datetime) -> DataFrame:
    return res.select(
        F.lit(run_id).alias("run_id"), F.lit(c.name).alias("dataset"),
        F.col(PART_DATE).alias("part_date"), F.col("_label").alias("partition"), "dim", "category", "rule_id", "rule_kind",
        "column", "severity", "success", "element_count", "missing_count", "unexpected_count", "unexpected_percent",
        "observed_num", "observed_text", "lo", "hi", "sample", "error", "note",
        _instant(now).alias("run_at"))


def never_landed(source: reconcile.SourceCounts, partitions: DataFrame, c: Contract, *, now: dt.datetime, run_id: str) -> DataFrame:
    """A failed row count for every day that the source has and no partition holds."""
    p = Plan()
    rid = p.rule(9, "row_count", c.source_table, note="the day never landed")
    days = source.days.join(partitions.select(F.col("part_date").alias("day")), "day", "left_anti").select(
        F.col("day").cast("string").alias(PART), F.col("day").alias(PART_DATE), "source_rows")
    found = _rows(days, [{"rule_id": rid, "success": False, "observed_num": F.lit(0.0),
                          "observed_text": F.concat(F.lit("source "), F.col("source_rows").cast("string"))}])
    found = found.join(small_table(days.sparkSession, list(p.meta.values()), _META), "rule_id")
    return _results(found.withColumns({"sample": F.lit(None).cast("array<string>"), "_label": F.col(PART)}), c, run_id, now)


def _z_rules(work: DataFrame, m: DataFrame, p: Plan, threshold: float) -> list[DataFrame]:
    """Outliers by z-score. A partition whose extremes are below the threshold has none; only the others are read again."""
    far = F.lit(False)
    for n in p.z_rules:
        mean, sd = F.col(f"{n}__mean"), F.col(f"{n}__sd")
        reach = F.greatest(distribution.z_score(F.col(f"{n}__min"), mean, sd), distribution.z_score(F.col(f"{n}__max"), mean, sd))
        far = far | F.coalesce(reach >= threshold, F.lit(False))
    flagged = m.withColumn("_far", far)
    calm = [{"rule_id": rid, "success": F.lit(True), "element_count": F.col("rows"),
             "missing_count": F.col("rows") - F.col(f"{n}__n"), "unexpected_count": F.lit(0),
             "unexpected_percent": F.when(F.col(f"{n}__n") > 0, F.lit(0.0))} for n, rid in p.z_rules.items()]
    z = distribution.z_outliers(work, GROUP, {n: F.col(number_column(n)) for n in p.z_rules}, flagged.filter("_far"), threshold)
    return [_rows(flagged.filter("NOT _far"), calm), _shape(_named(z, "column", p.z_rules))]


def _all_values(states: dict[str, DataFrame]) -> DataFrame:
    """Counted values of all profiled columns: those in range, and the rejected ones."""
    rejects = states["rejects"].groupBy(PART, "column", F.col("value").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return states["numbers"].select(PART, "column", "v", "n").unionByName(rejects)


def _order_rules(work: DataFrame, held: DataFrame, p: Plan, states: dict[str, DataFrame] | None = None) -> list[DataFrame]:
    """Quantile shape and zero medians from one set of order statistics.

    A partition without a value of the column passes and says so.
    """
    cols = {n: F.col(number_column(n)) for n in dict.fromkeys([*p.quantiles, *p.medians])}
    ranks = {str(q): (lambda n, q=q: order_stats.nearest_rank(q, n)) for q in QS} if p.quantiles else {}
    if p.medians:
        ranks |= {"low": order_stats.middle_low, "high": order_stats.middle_high}
    if states:
        found = order_stats.exact_ranks(_all_values(states).filter(F.col("column").isin(*cols)), [PART], ranks, weight="n")
        found = order_stats.same_group(found, held.select(*GROUP), [PART])
    else:
        found = order_stats.exact_ranks(order_stats.long_values(work, GROUP, cols), GROUP, ranks)
    wide = found.groupBy(*GROUP, "column").pivot("name", list(ranks)).agg(F.first("value"))
    groups = held.select(*[F.col(g).alias(f"_{g}") for g in GROUP]).distinct()
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in GROUP]
    none = F.col("column").isNull()
    out = []
    for n, (rid, corridor) in p.quantiles.items():
        ok, shown = F.lit(True), []
        for q, (lo, hi) in corridor.items():
            v = F.col(f"`{q}`")
            ok = ok & v.between(lo, hi)
            shown.append(F.concat(F.lit(f"p{q}="), v.cast("string")))
        out.append({"name": n, "rule_id": rid, "success": none | ok,
                    "observed_text": F.when(none, "no value").otherwise(F.concat_ws(", ", *shown))})
    for n, rid in p.medians.items():
        med = (F.col("low") + F.col("high")) / 2
        out.append({"name": n, "rule_id": rid, "success": none | (med == 0), "observed_num": med,
                    "observed_text": F.when(none, "no value")})
    frames = []
    for name in cols:
        items = [o for o in out if o["name"] == name]
        one = groups.join(wide.filter(F.col("column") == name), same, "left").drop(*GROUP)
        frames.append(_rows(one.withColumnsRenamed({f"_{g}": g for g in GROUP}), items))
    return frames
