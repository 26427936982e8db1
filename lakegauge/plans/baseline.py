"""Baseline: what the historical partitions of a dataset look like.

First level: one row per (partition, column), from grouped passes over the history. Second
level: corridors over those rows. Scalars, whose number the contract bounds, come to the driver
because they become literals in the rules; code lists and mappings stay tables.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.contract import Contract
from lakegauge.functions import numbers, times
from lakegauge.operators import distribution, keys, membership, onepass, order_stats
from lakegauge.operators.prepare import PART, PART_DATE
from lakegauge.plans import patterns
from lakegauge.session import materialise, small_table, together
from lakegauge.sources import commits

QS = (0.5, 0.75, 0.95, 0.99)                 # corridor quantiles
GLOBAL_QS = (0.5, 0.75, 0.9, 0.95, 0.99)     # informational
_COLUMNS_PER_PASS = 8


@dataclass
class Baseline:
    dataset: str
    meta: dict = field(default_factory=dict)
    volume: dict = field(default_factory=dict)
    missing: dict[str, dict] = field(default_factory=dict)
    distribution: dict[str, dict] = field(default_factory=dict)
    text: dict[str, dict] = field(default_factory=dict)
    master_sizes: dict[str, int] = field(default_factory=dict)
    relation_sizes: dict[str, int] = field(default_factory=dict)
    master: DataFrame | None = None
    relations: DataFrame | None = None
    violations: DataFrame | None = None
    rejects: DataFrame | None = None
    partitions: DataFrame | None = None

    SCALARS = ("meta", "volume", "missing", "distribution", "text", "master_sizes", "relation_sizes")
    TABLES = ("master", "relations", "violations", "rejects", "partitions")


def exclude_partitions(frame: DataFrame, names: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Keep the target out of its own baseline: the named partitions, or the newest one.

    The newest is a single value; with only one partition nothing can be left out.
    """
    if names:
        return frame.filter(F.col(PART).isNull() | ~F.col(PART).isin(names)), list(names)
    newest = frame.select(PART, PART_DATE).distinct().agg(F.max(F.struct(F.coalesce(F.col(PART_DATE), F.lit("0001-01-01").cast("date")), F.col(PART))).alias("m"),
                                                          F.min(PART).alias("a"), F.max(PART).alias("z")).first()
    if newest["m"] is None or newest["a"] == newest["z"]:
        return frame, []
    name = newest["m"][1]
    return frame.filter(~F.col(PART).eqNullSafe(F.lit(name))), [name]


def in_range(x: Column, bounds: tuple | None) -> Column:
    return F.when(x.between(*bounds), x) if bounds else x


def profiled_numbers(frame: DataFrame, c: Contract) -> dict[str, Column]:
    """In-range numeric value of every profiled column that can be profiled."""
    out = {}
    for k in c.profiled_columns:
        if k.name in frame.columns:
            t = frame.schema[k.name].dataType
            if not numbers.is_temporal(t):
                out[k.name] = in_range(numbers.as_number(F.col(k.name), t), k.bounds)
    return out


def column_stats(frame: DataFrame, c: Contract, group: list[str]) -> DataFrame:
    """One row per group and contract column: rows, nulls, text length range, numeric statistics."""
    nums = profiled_numbers(frame, c)
    present = [k for k in c.columns if k.name in frame.columns]
    passes = [present[i:i + _COLUMNS_PER_PASS] for i in range(0, len(present), _COLUMNS_PER_PASS)]
    out = None
    for cols in passes:
        aggs, rows = [F.count(F.lit(1)).alias("_n")], []
        for i, k in enumerate(cols):
            col = numbers.no_nan(F.col(k.name), frame.schema[k.name].dataType)
            aggs.append(F.count(col).alias(f"_c{i}"))
            fields = [F.lit(k.name).alias("column"), F.col("_n").alias("rows"),
                      (F.col("_n") - F.col(f"_c{i}")).alias("nulls")]
            is_text = k.kind == "string"
            if is_text:
                size = F.length(F.col(k.name).cast("string"))
                aggs += [F.min(size).alias(f"_l{i}"), F.max(size).alias(f"_h{i}")]
            fields += [(F.col(f"_l{i}") if is_text else F.lit(None).cast("int")).alias("len_min"),
                       (F.col(f"_h{i}") if is_text else F.lit(None).cast("int")).alias("len_max")]
            x = nums.get(k.name)
            if x is not None:
                aggs += [F.count(x).alias(f"_k{i}"), F.avg(x).alias(f"_m{i}"), F.stddev_pop(x).alias(f"_s{i}"),
                         F.min(x).alias(f"_a{i}"), F.max(x).alias(f"_z{i}"), F.count_if(x == 0).alias(f"_o{i}")]
            for src, name, typ in (("_k", "n", "bigint"), ("_m", "mean", "double"), ("_s", "sd", "double"),
                                   ("_a", "min", "double"), ("_z", "max", "double"), ("_o", "zeros", "bigint")):
                fields.append((F.col(f"{src}{i}") if x is not None else F.lit(None)).cast(typ).alias(name))
            rows.append(F.struct(*fields))
        part = frame.groupBy(*group).agg(*aggs).select(*group, F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out


def volume_corridor(part_rows: DataFrame, tolerance: float) -> DataFrame:
    """Row counts over partitions: min, floored median, max and the tolerated band around the median."""
    med = F.floor(F.median("rows"))
    return part_rows.agg(F.min("rows").alias("rows_min"), F.max("rows").alias("rows_max"), med.alias("rows_median"),
                         F.count(F.lit(1)).alias("partitions")).withColumns({
                             "rows_low": F.floor(F.col("rows_median") * F.lit(1 - tolerance)),
                             "rows_high": F.floor(F.col("rows_median") * F.lit(1 + tolerance))})


def null_corridor(stats: DataFrame, margin: float) -> DataFrame:
    """Null share over partitions per column, and the smallest share of present values still accepted.

    The mean is summed in decimals: doubles give other last digits when partitions come in another order.
    """
    rate = F.col("nulls") / F.col("rows")
    return stats.groupBy("column").agg(
        F.min(rate).alias("null_min"), F.max(rate).alias("null_max"), F.avg(rate.cast("decimal(20,18)")).cast("double").alias("null_mean"),
    ).withColumn("min_present", F.bround(F.greatest(F.lit(0.0), 1.0 - (F.col("null_max") + margin)), 4))


def distinct_estimate(values: str) -> Column:
    """Estimated number of distinct values; a sketch that was never merged estimates by the order of its values, one merged with itself doesn't."""
    found = F.hll_sketch_agg(values)
    return F.hll_sketch_estimate(F.hll_union(found, found))


def numeric_corridor(stats: DataFrame) -> DataFrame:
    """Spread of the per-partition statistics, and the global mean and deviation merged from them."""
    s = stats.filter(F.col("n") > 0)
    zero = F.col("zeros") / F.col("n")
    g = s.groupBy("column").agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean_global"),
        F.min("mean").alias("mean_min"), F.max("mean").alias("mean_max"), F.max("sd").alias("sd_max"),
        F.min(zero).alias("zero_min"), F.max(zero).alias("zero_max"), F.min("min").alias("min"),
        F.max("max").alias("max"))
    spread = s.select("column", F.col("n").alias("_n"), F.col("mean").alias("_m"), F.col("sd").alias("_s")).join(
        g.select("column", "mean_global"), "column").groupBy("column").agg(
        F.sqrt(F.sum(F.col("_n") * (F.col("_s") * F.col("_s") + F.pow(F.col("_m") - F.col("mean_global"), 2)))
               / F.sum("_n")).alias("sd_global"))
    return g.join(spread, "column")


def histogram(frame: DataFrame, values: dict[str, Column], bins: dict[str, list[float]]) -> DataFrame:
    """Rows per bin and column over the whole frame, in one pass without a shuffle of values."""
    aggs, rows = [], []
    for i, (name, x) in enumerate(values.items()):
        counts = distribution.bin_counts(x, bins[name], f"_h{i}")
        aggs += [v.alias(k) for k, v in counts.items()]
        inner = list(counts)[1:-1]
        rows += [F.struct(F.lit(name).alias("column"), F.lit(j).alias("bin"), F.lit(bins[name][j]).alias("low"),
                          F.lit(bins[name][j + 1]).alias("high"), F.col(k).alias("rows"))
                 for j, k in enumerate(inner)]
    return frame.agg(*aggs).select(F.inline(F.array(*rows)))


def histogram_of_counts(numbers: DataFrame, bins: dict[str, list[float]]) -> DataFrame:
    """Rows per column and bin, from counted values (column, v, n): folded per bin before the shuffle."""
    index = F.lit(None).cast("int")
    for name, edges in bins.items():
        x = F.col("v")
        inner = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges[1:-1]]), lambda e: e <= x))
        index = F.when((F.col("column") == name) & x.between(float(edges[0]), float(edges[-1])), inner).otherwise(index)
    return numbers.select("column", index.alias("bin"), "n").where("bin IS NOT NULL").groupBy("column", "bin").agg(F.sum("n").alias("rows"))


def reject_rows(frame: DataFrame, c: Contract) -> DataFrame:
    """Values outside their physical range, with the key columns that identify the row."""
    tests, ident = [], [k for k in dict.fromkeys([c.surrogate_key, *c.business_key]) if k and k in frame.columns]
    for k in c.profiled_columns:
        if k.bounds and k.name in frame.columns:
            x = numbers.as_number(F.col(k.name), frame.schema[k.name].dataType)
            tests.append(F.struct(F.lit(k.name).alias("column"), x.alias("value"),
                                  F.lit(float(k.bounds[0])).alias("low"), F.lit(float(k.bounds[1])).alias("high")))
    key = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in ident]) if ident \
        else F.lit(None).cast("string")
    if not tests:
        return frame.select(PART, F.lit(None).cast("string").alias("column"), F.lit(None).cast("double").alias("value"),
                            F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
                            key.alias("row_key")).filter(F.lit(False))
    return (frame.select(PART, key.alias("row_key"), F.inline(F.array(*tests)))
            .filter((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))
            .select(PART, "column", "value", "low", "high", "row_key"))


def mean_bounds(d: dict, bounds: tuple | None, margin: float, reference: bool) -> tuple[float, float]:
    """Corridor of the mean; symmetric widening keeps negative measures valid, 'reference' assumes positive ones."""
    lo = float(bounds[0]) if bounds else d["mean_min"]
    top = d["mean_max"]
    if top > 0:
        return lo, round(top * margin, 6)
    hi = float(bounds[1]) if bounds else d["max"]
    return (lo, hi) if reference or top == 0 else (lo, round(top + (margin - 1) * abs(top), 6))


def quantile_bounds(lo: float, hi: float, bounds: tuple | None, low_margin: float, high_margin: float,
                    reference: bool) -> tuple[float, float]:
    """Corridor of one quantile from its range over partitions."""
    cap = float(bounds[1]) if bounds else float("inf")
    if reference:
        return max(0.0, lo * low_margin), min(hi * high_margin if hi > 0 else 1.0, cap)
    top = 1.0 if hi == 0 else hi + (high_margin - 1) * abs(hi)
    return lo - (1 - low_margin) * abs(lo), min(top, cap)


#: what is remembered of a partition; every table has its partition column, and tables of partitions add up by union
STATES = ("stats", "numbers", "sketches", "quantiles", "codes", "pairs", "parts", "rejects")


def gather(frame: DataFrame, c: Contract) -> dict[str, DataFrame]:
    """States of all partitions of ``frame``, written tables.

    ``stats`` has counts, moments and extremes per column, ``numbers``, ``codes`` and ``pairs`` the counted values of profiled, of text
    and reference columns and of relations, ``sketches`` the distributions, ``quantiles`` the exact order statistics, ``parts``
    entities and periods, ``rejects`` rows out of range. A baseline follows from the states alone (``merge``).
    """
    nums = profiled_numbers(frame, c)
    coded = [n for n in dict.fromkeys([*c.text_columns, *c.reference_columns]) if n in frame.columns]
    rel = [p for p in c.relations if p[0] in frame.columns and p[1] in frame.columns]

    def parts() -> DataFrame:
        ts = times.as_time(F.col(c.event_time), frame.schema[c.event_time].dataType, c.epoch_unit) if c.event_time in frame.columns \
            and c.grain in ("jam", "hari") else None
        period = F.lit(None).cast("bigint") if ts is None else times.distinct_periods(F.hour(ts)) if c.grain == "jam" \
            else F.count_distinct(F.to_date(ts))
        out = frame.groupBy(PART).agg(period.alias("periods"))
        if not c.business_key or c.business_key[0] not in frame.columns:
            return out.withColumn("entities", F.lit(None).cast("bigint"))
        n = keys.distinct_count(frame, [PART], c.business_key[0], "entities").withColumnRenamed(PART, "_p")
        return out.join(n, F.col(PART).eqNullSafe(F.col("_p")), "left").drop("_p")

    def numbers_and_quantiles() -> dict[str, DataFrame]:
        long = order_stats.long_values(frame, [PART], nums) if nums else frame.select(
            PART, F.lit("").alias("column"), F.lit(0.0).alias("v")).where("false")
        counted = materialise(long.groupBy(PART, "column", "v").agg(F.count("*").alias("n")), "numbers")
        return {"numbers": counted,
                "sketches": materialise(long.groupBy(PART, "column").agg(order_stats.sketch().alias("sketch")), "sketches"),
                "quantiles": materialise(order_stats.quantiles(counted, [PART], list(GLOBAL_QS), weight="n"), "quantiles")}

    none = frame.select(PART, F.lit("").alias("column"), F.lit("").alias("code"), F.lit(0).cast("bigint").alias("_cnt")).where("false")
    no_pair = frame.select(PART, *[F.lit("").alias(k) for k in ("relation", "a", "b")], F.lit(0).cast("bigint").alias("_cnt")).where("false")
    got = together(
        stats=lambda: materialise(column_stats(frame, c, [PART, PART_DATE]), "column_stats"),
        numeric=numbers_and_quantiles,
        codes=lambda: materialise(onepass.value_counts(frame, [PART], coded) if coded else none, "codes"),
        pairs=lambda: materialise(membership.pair_counts(frame, [PART], rel) if rel else no_pair, "pairs"),
        parts=lambda: materialise(parts(), "parts"),
        rejects=lambda: materialise(reject_rows(frame, c), "rejects"))
    return {**{k: v for k, v in got.items() if k != "numeric"}, **got["numeric"]}


def merge(states: dict[str, DataFrame], c: Contract, left_out: list[str], corridors: str = "signed",
          now: dt.datetime | None = None) -> Baseline:
    """The baseline of the partitions whose states are given; no row of the dataset is read."""
    stats, codes, numbers = states["stats"], states["codes"], states["numbers"]
    have = [r["column"] for r in stats.select("column").distinct().collect()]
    first = next(k.name for k in c.columns if k.name in have) if have else None
    part_rows = stats.filter(F.col("column") == first).select(PART, PART_DATE, "rows")
    b = Baseline(c.name)
    t = c.thresholds
    reference = corridors == "reference"
    vol = volume_corridor(part_rows, t["toleransi_volume"]).first().asDict()
    if not vol["partitions"]:
        raise ValueError(f"{c.name}: every partition is excluded, no baseline can be built")
    texts = [n for n in c.text_columns if n in have]
    refs = [n for n in c.reference_columns if n in have]
    rel = [p for p in c.relations if p[0] in have and p[1] in have]
    learned_texts = [n for n in texts if not c.column(n).patterns]
    b.rejects, b.partitions = states["rejects"], part_rows

    def value_sets(build, by: str):
        def run():
            table = materialise(build(), by)
            return table, {r[by]: r["n"] for r in table.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}
        return run

    def quantiles():
        """Range over partitions, and the quantiles of the whole history from merged sketches and counted values."""
        per = states["quantiles"].groupBy("column", "name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        merged = states["sketches"].groupBy("column").agg(F.kll_merge_agg_double("sketch", F.lit(order_stats.SKETCH_K)).alias("sketch"))
        whole = order_stats.quantiles(numbers, [], list(GLOBAL_QS), weight="n", sketches=materialise(merged, "merged"))
        return per.join(whole.withColumnRenamed("value", "whole"), ["column", "name"]).collect()

    def numeric():
        d = {r["column"]: r.asDict() for r in numeric_corridor(stats).collect()}
        if not d:
            return {}, {}, {}
        bins = {}
        for name in d:
            bounds = c.column(name).bounds or (d[name]["min"], d[name]["max"])
            bins[name] = distribution.edges(float(bounds[0]), float(bounds[1]))
        hist = {n: [0] * (len(bins[n]) - 1) for n in d}
        for r in histogram_of_counts(numbers, bins).collect():
            hist[r["column"]][r["bin"]] = r["rows"]
        return d, bins, hist

    def text_sets():
        """Patterns, and exact and estimated numbers of distinct values, from the distinct values of all partitions."""
        values = materialise(codes.where(F.col("column").isin(*texts) & F.col("code").isNotNull()).select(
            "column", F.col("code").alias("value")).distinct(), "text_values")
        seen = {r["column"]: r for r in values.groupBy("column").agg(
            F.count("*").alias("n"), distinct_estimate("value").alias("about")).collect()}
        return patterns.derive_from_values(values.where(F.length("value") > 0), learned_texts), seen

    jobs = {
        "parts": lambda: states["parts"].agg(F.min("entities"), F.max("entities"), F.max("periods")).first(),
        "rejected": b.rejects.count,
        "nulls": lambda: null_corridor(stats, t["margin_null"]).collect(),
        "lengths": lambda: stats.filter(F.col("len_min").isNotNull()).groupBy("column").agg(
            F.min("len_min").alias("lo"), F.max("len_max").alias("hi")).collect(),
        "quantiles": quantiles, "numeric": numeric,
    }
    if texts:
        jobs["texts"] = text_sets
    if refs:
        jobs["master"] = value_sets(lambda: codes.where(F.col("column").isin(*refs) & F.col("code").isNotNull()).select(
            "column", "code").distinct(), "column")
    if rel:
        jobs["relations"] = value_sets(lambda: states["pairs"].where("a IS NOT NULL AND b IS NOT NULL").select(
            "relation", "a", "b").distinct(), "relation")
    got = together(**jobs)

    low, high, most = got["parts"]
    b.volume = {**vol, "entities_min": low, "entities_max": high, "periods": most or None}
    for r in got["nulls"]:
        d = r.asDict()
        k = c.column(d.pop("column"))
        b.missing[k.name] = {**d, "min_present": 1.0 if k.required else d["min_present"]}
    dist, bins, hist = got["numeric"]
    for name, d in dist.items():
        bounds, total = c.column(name).bounds, sum(hist[name])
        mine = sorted((r for r in got["quantiles"] if r["column"] == name), key=lambda r: float(r["name"]))
        d.pop("column")
        d["bins"], d["weights"] = bins[name], [h / total if total else 0.0 for h in hist[name]]
        d["mean_low"], d["mean_high"] = mean_bounds(d, bounds, t["margin_mean"], reference)
        d["sd_high"] = round(max(d["sd_max"] * t["margin_stdev"], 1e-6), 6)
        d["quantiles"] = {r["name"]: r["whole"] for r in mine}
        d["quantile_range"] = {r["name"]: (r["lo"], r["hi"]) for r in mine if float(r["name"]) in QS}
        d["quantile_corridor"] = {
            q: quantile_bounds(lo, hi, bounds, t["margin_kuantil_bawah"], t["margin_kuantil_atas"], reference)
            for q, (lo, hi) in d["quantile_range"].items()}
        b.distribution[name] = d
    lens = {r["column"]: r for r in got["lengths"]}
    for n in texts:
        if n in lens:
            own, (found, seen) = c.column(n).patterns, got["texts"]
            b.text[n] = {"patterns": own or found[n], "declared": bool(own), "len_min": lens[n]["lo"], "len_max": lens[n]["hi"],
                         "distinct_values": seen[n]["n"] if n in seen else 0, "distinct_estimate": seen[n]["about"] if n in seen else 0}
    if refs:
        b.master, b.master_sizes = got["master"]
    if rel:
        b.relations, b.relation_sizes = got["relations"]
        b.violations = membership.relation_violations(b.relations)
    b.meta = {"dataset": c.name, "description": c.description, "partitions_used": vol["partitions"],
              "partitions_excluded": left_out, "circular": not left_out, "rejected_values": got["rejected"],
              "built_at": (now or dt.datetime.now(dt.timezone.utc)).isoformat()}
    return b


def learn(frame: DataFrame, c: Contract, exclude: list[str] | None = None, corridors: str = "signed",
          now: dt.datetime | None = None) -> Baseline:
    """Learn the baseline of a dataset from a frame that carries its partition columns."""
    history, left_out = exclude_partitions(frame, exclude)
    return merge(gather(history, c), c, left_out, corridors, now)


def learn_from(states: dict[str, DataFrame], c: Contract, exclude: list[str] | None = None, corridors: str = "signed",
               now: dt.datetime | None = None) -> Baseline:
    """As ``learn``, from the states of all partitions (``gather``), which ``evaluate`` can use once more."""
    _, left_out = exclude_partitions(states["stats"], exclude)
    used = F.lit(True)
    for name in left_out:
        used = used & ~F.col(PART).eqNullSafe(F.lit(name))
    return merge({n: s.filter(used) for n, s in states.items()}, c, left_out, corridors, now)


def remembered(spark: SparkSession, c: Contract, store: str) -> DataFrame:
    """Partitions whose states are stored, with the fingerprint of what they were learned from."""
    if not commits.any_commit(spark, _states(c, store), "parts"):
        return spark.createDataFrame([], f"{PART} string, fingerprint long")
    return commits.committed(spark, _states(c, store), "parts", [PART]).select(PART, "fingerprint")


def _states(c: Contract, store: str) -> str:
    return f"{store.rstrip('/')}/dataset={c.name}/states"


def relearn(spark: SparkSession, c: Contract, store: str, partitions: DataFrame, read: Callable[[DataFrame], DataFrame], *,
            exclude: list[str] | None = None, corridors: str = "signed", now: dt.datetime | None = None) -> Baseline:
    """The baseline of ``partitions`` (part, part_date, fingerprint); only those that aren't remembered as they are now are read.

    ``read`` gets the partitions to read (part) and returns their rows. States are committed per partition, ``parts`` last, so
    a run that stopped is simply repeated; what was learned of a partition with another fingerprint is replaced. The newest partition
    is left out, or those that ``exclude`` names. Equal to ``learn`` over the same partitions.
    """
    named = partitions.select(F.col("part").alias(PART), F.col("part_date").alias(PART_DATE), "fingerprint")
    used, left_out = exclude_partitions(named, exclude)
    used = materialise(used, "partitions")
    fresh = used.join(remembered(spark, c, store), [PART, "fingerprint"], "left_anti")
    if not fresh.isEmpty():
        found, where = gather(read(fresh.select(F.col(PART).alias("part"))), c), _states(c, store)
        found["parts"] = found["parts"].join(fresh.select(PART, "fingerprint"), PART)
        for name in sorted(STATES, key=lambda n: n == "parts"):
            commits.commit(found[name], where, name, [PART], fresh)
    keep = used.select(PART)
    states = {n: commits.committed(spark, _states(c, store), n, [PART]).join(keep, PART, "left_semi") for n in STATES}
    return merge(states, c, left_out, corridors, now)


def save(b: Baseline, root: str, spark: SparkSession) -> str:
    """Write a baseline below ``root/dataset=<name>``: one JSON document of scalars and the tables."""
    base = f"{root.rstrip('/')}/dataset={b.dataset}"
    doc = json.dumps({k: getattr(b, k) for k in Baseline.SCALARS}, ensure_ascii=False)
    small_table(spark, [{"value": doc}], pa.schema([("value", pa.string())])).coalesce(1).write.mode("overwrite").text(
        f"{base}/scalars")
    for name in Baseline.TABLES:
        table = getattr(b, name)
        if table is not None:
            table.write.mode("overwrite").parquet(f"{base}/{name}")
    return base


def exists(spark: SparkSession, root: str, dataset: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/dataset={dataset}/scalars/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load(spark: SparkSession, root: str, dataset: str) -> Baseline:
    base = f"{root.rstrip('/')}/dataset={dataset}"
    doc = json.loads(spark.read.text(f"{base}/scalars", wholetext=True).first()[0])
    b = Baseline(dataset, **doc)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in Baseline.TABLES:
        p = jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
        if p.getFileSystem(conf).exists(p):
            setattr(b, name, spark.read.parquet(f"{base}/{name}"))
    return b


def to_build(spark: SparkSession, root: str, names: list[str], rebuild: bool = True) -> list[str]:
    """Datasets whose baseline has to be built: all of them, or only those that have none."""
    return [n for n in names if rebuild or not exists(spark, root, n)]
