"""Landed tables against their source: counts, columns and rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.session import materialise, small_table
from lakegauge.sources import external


def source_day(ts: Column, offset_hours: float = 0.0) -> Column:
    """Day whose shifted window holds the source time."""
    return F.to_date(ts.cast("timestamp_ntz") - F.make_dt_interval(mins=F.lit(int(round(offset_hours * 60)))))


def daily_counts(df: DataFrame, day: Column, name: str) -> DataFrame:
    return df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias(name))


@dataclass
class SourceCounts:
    """What reconciliation needs of a source: its column names, rows per day, and all rows."""

    columns: list[str]
    days: DataFrame | None      # (day, source_rows); None if the source has no time column
    total: int


def count_source(source: DataFrame, time_column: str | None, offset_hours: float = 0.0, day: dt.date | None = None) -> SourceCounts:
    """Count a source once, by day if it has a time column.

    With ``day`` only that day is read: the bounds are literals on the bare column, so they reach the source. Rows without a
    time belong to no day but to the total.
    """
    if not time_column:
        return SourceCounts(source.schema.names, None, source.count())
    if day is not None:
        source = external.in_window(source, time_column, day, offset_hours)
    at = source_day(F.col(time_column), offset_hours)
    days = materialise(daily_counts(source, at, "source_rows"), "source_days")
    total = days.agg(F.sum("source_rows")).first()[0] or 0
    return SourceCounts(source.schema.names, days.filter("day IS NOT NULL"), total)


def reconcile_counts(landed: DataFrame, source: DataFrame, landed_day: Column, source_day_: Column) -> DataFrame:
    """All days at once: rows landed and rows in the source; a day missing on one side counts zero there."""
    a, b = daily_counts(landed, landed_day, "landed_rows"), daily_counts(source, source_day_, "source_rows")
    j = a.join(b, a["day"].eqNullSafe(b["day"]), "full").select(
        F.coalesce(a["day"], b["day"]).alias("day"), F.coalesce("landed_rows", F.lit(0)).alias("landed_rows"),
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"))
    return j.withColumn("success", F.col("landed_rows") == F.col("source_rows"))


def within_tolerance(counts: DataFrame, share: float = 0.01) -> DataFrame:
    """Difference of at most a share of the source rows passes; more is a warning."""
    diff = F.abs(F.col("landed_rows") - F.col("source_rows"))
    return counts.drop("success").withColumn("difference", diff).withColumn(
        "success", diff <= F.lit(share) * F.col("source_rows"))


_NAMES = pa.schema([("column", pa.string())])


def _names(df: DataFrame) -> DataFrame:
    return small_table(df.sparkSession, [{"column": n} for n in df.schema.names], _NAMES)


def missing_columns(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Source columns that did not land; extra landed columns are fine."""
    return _names(source).join(_names(landed), "column", "left_anti")


def common_columns(source: DataFrame, landed: DataFrame) -> DataFrame:
    return _names(source).intersect(_names(landed))


#: ranges of one digest level
RANGES = 4096
#: a range of at most so many rows is not divided further
RANGE_ROWS = 1_000_000
_SPAN = 1 << 62
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class _Sides:
    """Both sides as (key, position, row hash); the position places a row in the tree."""

    source: DataFrame
    landed: DataFrame
    key: list[str]
    ordered: bool               # positions are the values of the leading key column, so that ranges reach the scan


def _sides(source: DataFrame, landed: DataFrame, key: list[str], columns: list[str] | None) -> _Sides:
    cols = columns or [c for c in source.columns if c in landed.columns and c not in key]
    types = {f.name: f.dataType for f in source.schema}
    keys = source.select(*key).unionByName(landed.select(*key)).schema
    ordered = isinstance(keys[key[0]].dataType, (*_WHOLE, T.DateType)) and all(
        d.schema[key[0]].dataType == keys[key[0]].dataType for d in (source, landed))

    def side(df: DataFrame) -> DataFrame:
        # a value that does not fit the source's type differs from every value and from null
        values = [x for c in cols for x in (F.col(c).try_cast(types[c]), F.col(c).isNull())]
        df = df.withColumns({n: F.col(n).cast(keys[n].dataType) for n in key if df.schema[n].dataType != keys[n].dataType})
        k = [F.col(n) for n in key]
        if not ordered:
            at = F.shiftright(F.xxhash64(*k), 2)                          # 62 bits: differences fit a bigint
        elif isinstance(keys[key[0]].dataType, T.DateType):
            at = F.unix_date(key[0]).cast("bigint")
        else:
            at = F.col(key[0]).cast("bigint")
        return df.select(*k, at.alias("_at"), F.xxhash64(*[x for n in k for x in (n, n.isNull())], *values).alias("_h"))

    return _Sides(side(source), side(landed), key, ordered)


def _fold(parts: DataFrame, by: list[str | Column]) -> DataFrame:
    """Order-free digests of both sides: counts, and the row hashes folded by exclusive or and their upper halves by sums."""
    src = F.col("_s") == 1
    high = F.shiftrightunsigned("_h", 32)                                 # 32 bits: sums over 2^31 copies fit a bigint
    return parts.groupBy(*by).agg(
        F.count_if(src).alias("source_rows"), F.count_if(~src).alias("landed_rows"),
        F.bit_xor("_h").alias("_x"), F.sum(F.when(src, high).otherwise(-high)).alias("_d"))


def _same() -> Column:
    return (F.col("source_rows") == F.col("landed_rows")) & (F.col("_x") == 0) & (F.col("_d") == 0)


def _stacked(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.withColumn("_s", F.lit(1)).unionByName(b.withColumn("_s", F.lit(0)))


def _intervals(numbers: list[int], most: int = 64) -> list[tuple[int, int]]:
    """At most so many intervals (ends included) that cover the numbers, the smallest gaps closed first."""
    numbers = sorted(numbers)
    gaps = sorted(range(1, len(numbers)), key=lambda i: (numbers[i - 1] - numbers[i], i))[:most - 1]
    cuts = [0, *sorted(i for i in gaps if numbers[i] - numbers[i - 1] > 1), len(numbers)]
    return [(numbers[a], numbers[b - 1]) for a, b in zip(cuts, cuts[1:]) if b > a]


@dataclass
class DigestTree:
    """Where two tables differ: ranges of 2^bits positions, numbered from ``low``, and whether rows without a position do."""

    sides: _Sides
    low: int
    high: int
    bits: int
    differing: list[int]
    nulls_differ: bool = True
    levels: list[dict] = field(default_factory=list)       # per level: bits, ranges read, ranges that differ, rows read, rows in these

    def _hit(self) -> Column:
        # as SQL text: thousands of numbers parse faster than they become columns one by one
        numbers = ", ".join(f"{n}L" for n in self.differing)
        hit = F.expr(f"shiftright(_at - {self.low}L, {self.bits}) IN ({numbers})") if numbers else F.lit(False)
        return F.when(F.col("_at").isNull(), F.lit(self.nulls_differ)).otherwise(hit)

    def _pushed(self) -> Column:
        """The ranges as comparisons of the bare leading key, which scans use to skip files and row groups."""
        if not self.sides.ordered:
            return F.lit(True)
        name = self.sides.key[0]
        kind = self.sides.source.schema[name].dataType
        value = (lambda v: F.date_from_unix_date(F.lit(v))) if isinstance(kind, T.DateType) else (lambda v: F.lit(v).cast(kind))
        near = lambda v: value(max(self.low, min(v, self.high)))
        out = F.col(name).isNull() if self.nulls_differ else F.lit(False)
        for a, b in _intervals(self.differing):
            out = out | F.col(name).between(near(self.low + (a << self.bits)), near(self.low + ((b + 1) << self.bits) - 1))
        return out

    def differing_rows(self) -> DataFrame:
        """Rows of both sides in the differing ranges; only these are read again."""
        return _stacked(*[d.filter(self._pushed() & self._hit()) for d in (self.sides.source, self.sides.landed)])

    def equal_rows(self) -> DataFrame:
        """The source's rows in all other ranges; the landed ones are the same."""
        return self.sides.source.filter(~self._hit())

    def differences(self) -> DataFrame:
        """(key, source_rows, landed_rows, status) of the keys that do not match; nothing is read outside the differing ranges."""
        return self._statuses().filter("status <> 'match'")

    def _statuses(self) -> DataFrame:
        key = self.sides.key
        status = (F.when(F.col("landed_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra")
                  .when(_same(), "match").otherwise("changed"))
        return _fold(self.differing_rows(), key).select(*key, "source_rows", "landed_rows", status.alias("status"))

    def statuses(self) -> DataFrame:
        """``differences`` and the matching keys, which come from the source alone."""
        key = self.sides.key
        n = F.count(F.lit(1))
        equal = self.equal_rows().groupBy(*key).agg(n.alias("source_rows"), n.alias("landed_rows"))
        return self._statuses().unionByName(equal.withColumn("status", F.lit("match")))


def digest_tree(source: DataFrame, landed: DataFrame, key: list[str], columns: list[str] | None = None,
                ranges: int = RANGES, range_rows: int = RANGE_ROWS) -> DigestTree:
    """Find the key ranges in which two tables differ, level by level.

    The span of keys is cut into ranges; per range and side a digest is folded before the shuffle, so a level moves at most
    2 x ``ranges`` rows per task. Only ranges that differ are cut and read again, until each holds at most ``range_rows`` rows or
    one position, or a level does not halve the rows. Positions are the leading key column where it is a whole number or a
    date on both sides (its ranges are comparisons the scan can use), else a hash of the key. Rows without a leading key are a
    range of their own. Ranges with equal digests (counts, 64 bits of exclusive or, sums of 32 bits over key and values) are
    taken as equal. Both sides are read several times and must not change meanwhile.
    """
    sides = _sides(source, landed, key, columns)
    low, high = -(_SPAN >> 1), (_SPAN >> 1) - 1
    if sides.ordered:
        low, high = _stacked(sides.source, sides.landed).agg(F.min("_at"), F.max("_at")).first()
        if low is not None and high - low >= _SPAN:                       # differences would leave the bigint
            halves = [d.withColumn("_at", F.shiftright("_at", 2)) for d in (sides.source, sides.landed)]
            sides, low, high = _Sides(*halves, key, False), low >> 2, high >> 2
    if low is None:
        return DigestTree(sides, 0, 0, 0, [])
    tree = DigestTree(sides, low, high, (high - low).bit_length(), [0])
    before = None
    while True:
        step = min(tree.bits, max(1, (ranges // len(tree.differing)).bit_length() - 1))
        bits = tree.bits - step
        number = F.shiftright(F.col("_at") - low, bits)
        found = _fold(tree.differing_rows(), [number.alias("_r")]).select(
            "_r", _same().alias("same"), F.greatest("source_rows", "landed_rows").alias("n")).collect()   # one row per range
        wrong = {r["_r"]: r["n"] for r in found if not r["same"] and r["_r"] is not None}
        rows = sum(wrong.values())
        before = sum(r["n"] for r in found) if before is None else before
        tree.levels.append({"bits": bits, "read": len(tree.differing), "differing": len(wrong), "rows": rows})
        tree.bits, tree.differing = bits, sorted(wrong)
        tree.nulls_differ = any(r["_r"] is None and not r["same"] for r in found)
        if not wrong or bits == 0 or max(wrong.values()) <= range_rows or 2 * rows > before or len(wrong) >= ranges:
            return tree
        before = rows


def reconcile_rows(source: DataFrame, landed: DataFrame, key: list[str], columns: list[str] | None = None,
                   ranges: int = RANGES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Row-level comparison by key: one row per key with a status.

    Ranges with equal digests are not compared by key. In the others both sides are reduced to key and row hash, stacked, and
    folded by key: no join, so a key repeated on many rows does not multiply; its copies are compared as a multiset.
    """
    return digest_tree(source, landed, key, columns, ranges, range_rows).statuses()
