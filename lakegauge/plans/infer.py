"""Draft contracts inferred from existing data.

Each question is one aggregation over all columns or column pairs; the driver only sees one row
per column or pair.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.functions import numbers, times
from lakegauge.operators.prepare import PART, PART_DATE
from lakegauge.operators.schema import logical_kind
from lakegauge.session import materialise

# Name fragments that mark event and load time, in order of preference.
EVENT_NAMES = ("recorded_at", "reading_at", "event_at", "waktu", "tanggal", "createdate", "create_date", "waktupanen",
               "trans_date")
LOAD_NAMES = ("loaded_at", "load_at", "ingested_at", "etl_at", "updatedate")
KEY_NAMES = ("id", "kode", "code")
MAX_CODES = 200          # distinct values up to which a text column is a code column
_PAIRS = 24              # column pairs of one aggregation
_LG = 12                 # 2^12 registers per sketch: a standard error of 1.6 %
_EXACT_UNDER = 400       # columns the sketch puts below this get an exact distinct count


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: type, rows, nulls, estimated distinct values, numeric range, text length range. One pass."""
    fields = [f for f in df.schema if f.name not in (PART, PART_DATE) and (not columns or f.name in columns)]
    out = None
    for start in range(0, len(fields), 10):
        aggs, rows = [F.count(F.lit(1)).alias("_n")], []
        for i, f in enumerate(fields[start:start + 10]):
            kind, col = logical_kind(f.dataType), F.col(f.name)
            x = numbers.as_number(col, f.dataType) if kind in ("integer", "float", "decimal") else None
            size = F.length(col) if kind == "string" else None
            null_d, null_i = F.lit(None).cast("double"), F.lit(None).cast("int")
            aggs += [F.count(numbers.no_nan(col, f.dataType)).alias(f"_c{i}")]
            if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)):
                aggs.append(F.approx_count_distinct(col).alias(f"_d{i}"))
            else:
                aggs.append(F.lit(None).cast("bigint").alias(f"_d{i}"))
            if x is not None:
                aggs += [F.min(x).alias(f"_a{i}"), F.max(x).alias(f"_z{i}")]
            if size is not None:
                aggs += [F.min(size).alias(f"_l{i}"), F.max(size).alias(f"_h{i}")]
            rows.append(F.struct(
                F.lit(start + i).alias("ordinal"), F.lit(f.name).alias("column"), F.lit(kind).alias("kind"),
                F.col("_n").alias("rows"), (F.col("_n") - F.col(f"_c{i}")).alias("nulls"),
                F.col(f"_d{i}").alias("distinct_estimate"),
                (F.col(f"_a{i}") if x is not None else null_d).alias("min"),
                (F.col(f"_z{i}") if x is not None else null_d).alias("max"),
                (F.col(f"_l{i}") if size is not None else null_i).alias("len_min"),
                (F.col(f"_h{i}") if size is not None else null_i).alias("len_max")))
        part = df.agg(*aggs).select(F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("required", F.col("nulls") == 0)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact number of distinct non-null values of several columns, in one shuffle of (column, value)."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (df.select(F.inline(items)).filter("value IS NOT NULL").distinct()
            .groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values")))


def unique_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Is each column free of repeats inside every partition? One null is no repeat."""
    out = None
    for c in columns:
        one = (df.groupBy(PART, c).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("m"))
               .select(F.lit(c).alias("column"), (F.col("m") <= 1).alias("unique_per_partition")))
        out = one if out is None else out.unionByName(one)
    return out


def guess_key(names: list[str]) -> str | None:
    """Among columns unique in every partition, one whose name says id or code, else the first."""
    return next((n for n in names if any(k in n.lower() for k in KEY_NAMES)), names[0] if names else None)


def time_means(df: DataFrame, columns: list[str]) -> DataFrame:
    """Average instant of each time column, in microseconds."""
    aggs = [F.avg(times.micros_of(times.as_time(F.col(c), df.schema[c].dataType))).alias(f"m{i}") for i, c in enumerate(columns)]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean_micros")) for i, c in enumerate(columns)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def guess_times(columns: list[str], means: dict[str, float]) -> tuple[str | None, str | None]:
    """Event and load time: by name first; else the first time column, and the latest on average."""
    def by_name(fragments, banned):
        return next((c for f in fragments for c in columns if f in c.lower() and c != banned), None)
    event = by_name(EVENT_NAMES, None)
    load = by_name(LOAD_NAMES, event)
    event = event or (columns[0] if columns else None)
    if load == event:
        load = None
    if load is None and len(columns) > 1:
        latest = max(columns, key=lambda c: means.get(c) or float("-inf"))
        load = latest if latest != event else None
    return event, load


def grain_stats(df: DataFrame, event: str) -> DataFrame:
    """Share of full hours and midnights, number of hours seen, and the grain they suggest."""
    t = F.col(event)
    s = df.agg(times.distinct_periods(F.hour(t)).alias("hours_seen"),
               F.avg((F.minute(t) == 0).cast("int")).alias("full_hour_share"),
               F.avg((F.hour(t) == 0).cast("int")).alias("midnight_share"))
    return s.withColumn("grain", F.when((F.col("hours_seen") > 1) & (F.col("full_hour_share") > 0.9), "jam")
                        .when(F.col("midnight_share") > 0.9, "hari"))


def key_scores(df: DataFrame, candidates: list[str], event: str) -> DataFrame:
    """Share of distinct (column, event time) pairs among the rows; of several partitions the one with the least share."""
    part = F.col(PART) if PART in df.columns else F.lit(None).cast("string")
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in candidates])
    pairs = df.select(part.alias("_p"), F.col(event).alias("t"), F.inline(items)).groupBy("_p", "column", "value", "t").agg(
        F.count(F.lit(1)).alias("n"))
    each = pairs.groupBy("_p", "column").agg((F.count(F.lit(1)) / F.sum("n")).alias("score"))
    return each.groupBy("column").agg(F.min("score").alias("score"))


def dependencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """For every ordered pair of code columns: how many right values does a left value have at most?

    One shuffle of distinct value pairs per ``_PAIRS`` pairs, which is also how often a row is multiplied. To find
    dependencies among many columns use ``discover``.
    """
    out = None
    pairs = [p for a, b in combinations(columns, 2) for p in ((a, b), (b, a))]
    for start in range(0, len(pairs), _PAIRS):
        items = F.array(*[F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(a).cast("string").alias("x"),
                                   F.col(b).cast("string").alias("y")) for a, b in pairs[start:start + _PAIRS]])
        seen = df.select(F.inline(items)).filter("x IS NOT NULL AND y IS NOT NULL").distinct()
        part = seen.groupBy("left_column", "right_column", "x").agg(F.count(F.lit(1)).alias("targets"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("left_column", "right_column").agg(
        F.count(F.lit(1)).alias("left_values"), F.max("targets").alias("most_targets")).withColumn(
        "determines", (F.col("most_targets") == 1) & (F.col("left_values") > 1))


def pair_sketches(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Per pair of columns, over rows where both are present: rows, and estimates of the distinct left, right and pair values.

    Rows are not multiplied: three sketches of fixed size per pair, ``_PAIRS`` pairs in a scan.
    """
    out = None
    for start in range(0, len(pairs), _PAIRS):
        aggs, rows = [], []
        for i, (a, b) in enumerate(pairs[start:start + _PAIRS]):
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            # hashes that collide only lower an estimate of pairs, which prunes less
            forms = {"left": F.xxhash64(F.col(a).cast("string")), "right": F.xxhash64(F.col(b).cast("string")),
                     "pair": F.xxhash64(F.col(a).cast("string"), F.lit(0), F.col(b).cast("string"))}
            aggs.append(F.count_if(both).alias(f"_n{i}"))
            aggs += [F.hll_sketch_agg(F.when(both, h), _LG).alias(f"_{k}{i}") for k, h in forms.items()]
            rows.append(F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"_n{i}").alias("compared"),
                                 *[F.hll_sketch_estimate(f"_{k}{i}").alias(f"{k}_estimate") for k in forms]))
        part = df.agg(*aggs).select(F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out


def _may_equal(pair: int, single: int) -> bool:
    """Can the true numbers be equal? Six standard errors of the difference of two estimates, and two values for tiny ones."""
    return pair <= single * (1 + 6 * 1.04 * 2 ** 0.5 / 2 ** (_LG / 2)) + 2


def confirm(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """For ordered pairs: does the left value determine the right one, on all rows where both are present?

    One aggregation per left column over all its right ones: the group of a left value keeps the least and greatest 128-bit name of
    each right value, so neither rows nor values are multiplied. At least two left values are needed.
    """
    out = None
    for a in dict.fromkeys(p[0] for p in pairs):
        rights = [b for x, b in pairs if x == a]
        for start in range(0, len(rights), _PAIRS):
            some = rights[start:start + _PAIRS]
            names = [(i, s, F.xxhash64(F.lit(s), F.col(b).cast("string"))) for i, b in enumerate(some) for s in (0, 1)]
            names = [(i, s, F.when(F.col(some[i]).isNotNull(), h)) for i, s, h in names]
            groups = df.filter(F.col(a).isNotNull()).groupBy(F.col(a).cast("string").alias("_x")).agg(
                *[x for i, s, h in names for x in (F.min(h).alias(f"_a{i}_{s}"), F.max(h).alias(f"_z{i}_{s}"))])
            one = lambda i: (F.col(f"_a{i}_0") == F.col(f"_z{i}_0")) & (F.col(f"_a{i}_1") == F.col(f"_z{i}_1"))
            rows = groups.agg(*[x for i in range(len(some)) for x in (F.count(f"_a{i}_0").alias(f"_n{i}"), F.count_if(~one(i)).alias(f"_d{i}"))])
            part = rows.select(F.inline(F.array(*[
                F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"_n{i}").alias("left_values"),
                         ((F.col(f"_d{i}") == 0) & (F.col(f"_n{i}") > 1)).alias("determines")) for i, b in enumerate(some)])))
            out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Relations:
    """What ``discover`` found: ordered pairs where the left value determines the right one, and pairs of equal columns."""

    determines: dict[tuple[str, str], bool]
    equal: set[tuple[str, str]]
    tried: int                       # ordered pairs the sketches could not rule out


def discover(df: DataFrame, columns: list[str], wanted: list[tuple[str, str]] | None = None,
             maybe_equal: list[tuple[str, str]] | None = None) -> Relations:
    """Functional dependencies and equal columns among many columns: sketches rule pairs out, the rest is checked exactly.

    ``wanted`` are the ordered pairs of interest, ``maybe_equal`` the unordered ones, in the order of ``columns`` (default:
    all). The left value determines the right one only if there are as many value pairs as left values, and two columns are equal
    only if there are also as many right ones; a pair is ruled out when estimates differ by over six standard errors. The driver
    sees one row per pair of columns. How often a combination of values occurs decides nothing, so every step reads the
    distinct combinations, folded before their one shuffle: few for code columns, at most as many as rows.
    """
    every = list(combinations(columns, 2))
    wanted = [p for a, b in every for p in ((a, b), (b, a))] if wanted is None else wanted
    maybe_equal = every if maybe_equal is None else maybe_equal
    asked = {frozenset(p) for p in [*wanted, *maybe_equal]}
    ask = [p for p in every if frozenset(p) in asked]
    if not ask:
        return Relations({}, set(), 0)
    df = materialise(df.select(*[F.col(c).cast("string").alias(c) for c in columns if any(c in p for p in ask)]).distinct(), "combinations")
    fits: dict[tuple[str, str], bool] = {}
    for r in pair_sketches(df, ask).collect():
        a, b = r["left_column"], r["right_column"]
        for p, n in (((a, b), r["left_estimate"]), ((b, a), r["right_estimate"])):
            fits[p] = r["compared"] > 0 and _may_equal(r["pair_estimate"], n)
    left = [p for p in wanted if fits[p]]
    found = dict.fromkeys(wanted, False)
    if left:
        found |= {(r["left_column"], r["right_column"]): r["determines"] for r in confirm(df, left).collect()}
    alike = [p for p in maybe_equal if fits[p] and fits[p[::-1]]]
    equal = {(r["left_column"], r["right_column"]) for r in equal_columns(df, alike).collect() if r["equal"]} if alike else set()
    return Relations(found, equal, len(left))


def pick_relations(found: dict[tuple[str, str], bool], distinct: dict[str, int], order: list[str]) -> list[tuple[str, str]]:
    """One direction per pair, from the side with fewer values; equal sides follow the column order."""
    out = []
    for a, b in combinations(order, 2):
        if distinct[a] == distinct[b]:
            options = [(a, b)] if found.get((a, b)) or found.get((b, a)) else []
        else:
            few, many = sorted((a, b), key=lambda n: distinct[n])
            options = [(few, many)] if found.get((few, many)) else []
        out += options
    pos = {n: i for i, n in enumerate(order)}
    return sorted(out, key=lambda p: (pos[p[0]], pos[p[1]]))


def equal_columns(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Are two columns equal on every row where both are present? One aggregation per ``_PAIRS`` pairs."""
    out = None
    for start in range(0, len(pairs), _PAIRS):
        aggs, rows = [], []
        for i, (a, b) in enumerate(pairs[start:start + _PAIRS]):
            x, y = F.col(a).cast("string"), F.col(b).cast("string")
            aggs += [F.count_if(x.isNotNull() & y.isNotNull()).alias(f"_b{i}"), F.count_if(x != y).alias(f"_d{i}")]
            rows.append(F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"),
                                 F.col(f"_b{i}").alias("compared"), F.col(f"_d{i}").alias("different")))
        part = df.agg(*aggs).select(F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("equal", (F.col("compared") > 0) & (F.col("different") == 0))


def time_order(df: DataFrame, load: str, event: str) -> DataFrame:
    """Is the load time never before the event time?"""
    ok = (times.as_time(F.col(load), df.schema[load].dataType) >= times.as_time(F.col(event), df.schema[event].dataType))
    return df.agg(F.count(ok).alias("compared"), F.coalesce(F.min(ok), F.lit(False)).alias("always"))


def constant_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """Boolean columns with a single value, and that value."""
    aggs = [x for i, c in enumerate(columns) for x in (F.min(c).alias(f"_a{i}"), F.max(c).alias(f"_z{i}"))]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_a{i}").alias("low"), F.col(f"_z{i}").alias("high"))
            for i, c in enumerate(columns)]
    return df.agg(*aggs).select(F.inline(F.array(*rows))).select(
        "column", F.coalesce(F.col("low") == F.col("high"), F.lit(False)).alias("constant"), F.col("low").alias("value"))


@dataclass
class Draft:
    columns: list[dict] = field(default_factory=list)
    surrogate: str | None = None
    event_time: str | None = None
    load_time: str | None = None
    grain: str | None = None
    business_key: list[str] = field(default_factory=list)
    references: list[str] = field(default_factory=list)
    profiled: list[str] = field(default_factory=list)
    relations: list[tuple[str, str]] = field(default_factory=list)
    equal_pairs: list[tuple[str, str]] = field(default_factory=list)
    ordered_pairs: list[tuple[str, str]] = field(default_factory=list)
    flags: list[dict] = field(default_factory=list)
    partitions: int = 0


def infer(frame: DataFrame, max_partitions: int | None = None) -> Draft:
    """Draft contract from a frame that carries its partition columns: from all partitions, or the first so many."""
    parts = frame.select(PART, PART_DATE).distinct()
    df = frame
    if max_partitions is not None:
        names = [r[PART] for r in parts.orderBy(F.col(PART_DATE).asc_nulls_first(), PART).limit(max_partitions).collect()]
        df = frame.filter(F.col(PART).isin(names))
    n_parts = len(names) if max_partitions is not None else parts.count()
    d = Draft(partitions=n_parts)
    info = {r["column"]: r.asDict() for r in column_profile(df).orderBy("ordinal").collect()}
    small = [n for n, i in info.items() if i["distinct_estimate"] is not None and i["distinct_estimate"] < _EXACT_UNDER]
    exact = {r["column"]: r["distinct_values"] for r in distinct_values(df, small).collect()} if small else {}
    for n, i in info.items():
        i["distinct_values"] = exact.get(n, 0) if n in small else None       # exact; else only the estimate is known
        i["distinct"] = i["distinct_estimate"] if i["distinct_values"] is None else i["distinct_values"]
    d.columns = list(info.values())
    of = {k: [n for n, i in info.items() if i["kind"] == k] for k in
          ("integer", "string", "datetime", "boolean", "float", "decimal")}

    keyish = [n for n, i in info.items() if i["kind"] in ("integer", "string")
              and i["distinct_estimate"] >= 0.8 * i["rows"] / n_parts]
    if keyish:
        ok = {r["column"] for r in unique_columns(df, keyish).collect() if r["unique_per_partition"]}
        d.surrogate = guess_key([n for n in keyish if n in ok])
    means = {r["column"]: r["mean_micros"] for r in time_means(df, of["datetime"]).collect()} if of["datetime"] else {}
    d.event_time, d.load_time = guess_times(of["datetime"], means)
    codes = [n for n in of["string"] if info[n]["distinct_values"] and info[n]["distinct_values"] <= MAX_CODES]
    d.references = codes
    d.profiled = [n for n in info if info[n]["kind"] in ("decimal", "float") and info[n]["max"] is not None
                  and info[n]["distinct"] > 5]
    if d.event_time:
        d.grain = grain_stats(df, d.event_time).first()["grain"]
        d.business_key = [d.event_time]
        cand = [n for n in codes if info[n]["distinct_values"] > 1]
        if cand:
            best = max(key_scores(df, cand, d.event_time).collect(), key=lambda r: (r["score"], r["column"]),
                       default=None)
            if best and best["score"] > 0.98:
                d.business_key = [best["column"], d.event_time]
    if len(codes) > 1:
        counts = {n: info[n]["distinct_values"] for n in codes}
        pairs = list(combinations(codes, 2))
        level = [p for p in pairs if counts[p[0]] == counts[p[1]]]
        few_first = [p if counts[p[0]] < counts[p[1]] else p[::-1] for p in pairs if counts[p[0]] != counts[p[1]]]
        found = discover(df, codes, few_first + level + [p[::-1] for p in level], level)
        d.relations = pick_relations(found.determines, counts, codes)
        d.equal_pairs = [p for p in level if p in found.equal]
    if d.event_time and d.load_time and time_order(df, d.load_time, d.event_time).first()["always"]:
        d.ordered_pairs = [(d.load_time, d.event_time)]
    if of["boolean"]:
        d.flags = [{"flag": r["column"], "harus": r["value"], "severity": "warning"}
                   for r in constant_flags(df, of["boolean"]).collect() if r["constant"]]
    return d


_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_WORDS = {"y", "n", "yes", "no", "true", "false", "on", "off", "null"}


def _scalar(name: str) -> str:
    """A name as a YAML scalar; quoted unless it can only be read as itself."""
    return name if _PLAIN.fullmatch(name) and name.lower() not in _WORDS else json.dumps(name, ensure_ascii=False)


def to_yaml(d: Draft, name: str, local: str | None = None, remote: str | None = None, partitioning: str = "harian") -> str:
    """The draft as a contract block; lines that are guesses say so."""
    out = [f"  {_scalar(name)}:", f"    deskripsi: {json.dumps('TODO: describe ' + name, ensure_ascii=False)}", "    sumber:"]
    out += [f"      lokal: {json.dumps(local, ensure_ascii=False)}"] if local else []
    out += [f"      s3: {json.dumps(remote, ensure_ascii=False)}"] if remote else []
    out += [f"      partisi: {partitioning}", "    kunci:"]
    guess = "   # guess, please check"
    one = lambda n: _scalar(n) if n else None
    keys = [("surrogate", one(d.surrogate)), ("bisnis", f"[{', '.join(map(_scalar, d.business_key))}]" if len(d.business_key) > 1 else None),
            ("waktu", one(d.event_time)), ("waktu_muat", one(d.load_time)), ("granularitas", d.grain)]
    shown = [f"      {k}: {v}{guess}" for k, v in keys if v]
    out = out + shown if shown else out[:-1]
    out.append("    kolom:")
    for i in d.columns:
        parts = [f"nama: {_scalar(i['column'])}", f"tipe: {'string' if i['kind'] == 'unsupported' else i['kind']}"]
        parts += ["wajib: false"] if not i["required"] else []
        parts += ["referensi: true"] if i["column"] in d.references else []
        note = [f"{i['nulls'] / i['rows']:.1%} null"] if i["nulls"] and i["rows"] else []
        if i["kind"] == "unsupported":
            note.append("nested type, not supported by the rules")
        elif i["kind"] == "string":
            about = "" if i["distinct_values"] is not None else "about "
            note.append(f"{about}{i['distinct']} values, length {i['len_min']}-{i['len_max']}")
        elif i["max"] is not None:
            note.append(f"seen {i['min']:g}..{i['max']:g}")
        if i["column"] in d.profiled:
            note.append("for distribution rules add rentang: [min, max] and profil_distribusi: true")
        out.append(f"      - {{{', '.join(parts)}}}" + (f"   # {'; '.join(note)}" if note else ""))
    for key, pairs in (("relasi", d.relations), ("sama_nilai", d.equal_pairs), ("urutan_waktu", d.ordered_pairs)):
        if pairs:
            out.append(f"    {key}:{guess}")
            out += [f"      - [{_scalar(a)}, {_scalar(b)}]" for a, b in pairs]
    if d.flags:
        out.append(f"    flag_dq:{guess}")
        for f in d.flags:
            out += [f"      - flag: {_scalar(f['flag'])}", f"        harus: {str(f['harus']).lower()}",
                    f"        severity: {f['severity']}"]
    return "\n".join(out) + "\n"
