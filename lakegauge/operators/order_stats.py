"""Exact order statistics per group without shuffling or sorting all values.

A group's count, least and largest value come from one narrow scan. Where a group holds more values than one task should sort,
a KLL sketch of them brackets every wanted rank, the next scan counts the zones between the brackets' ends, and only zones
that hold a rank go on, by a sketch of their own as long as they are still too large. What is left, a bounded number of
rows per zone, is sorted and read off. Where every group is that small to begin with, one job reads all ranks off.

The counts alone decide which zone holds a rank, so the result is exact however far off a sketch may be. Every step is an
aggregation with map-side combine: a group with a third of all rows, or one value on a third of them, costs no more than any
other. A caller who knows that a column has few different values can have it counted by value in one job instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakegauge.session import materialise

#: rows of a zone that are sorted; sketch size, and the grid of ranks that brackets are taken from
BOUND, SKETCH_K, GRID = 16384, 1024, 128


def same_group(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on columns of equal names where null meets null; the small side's other columns are added."""
    s = small.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return big.join(s, cond).drop(*[f"_r_{c}" for c in on])


def lower_rank(q: float, n: Column) -> Column:
    """Index of the *lower* definition: floor(q * (n - 1))."""
    return F.floor(F.lit(float(q)) * (n - 1)).cast("bigint")


def nearest_rank(q: float, n: Column) -> Column:
    """Index of the *nearest* definition, halves to even."""
    return F.rint(F.lit(float(q)) * (n - 1)).cast("bigint")


def middle_low(n: Column) -> Column:
    return F.floor((n - 1) / 2).cast("bigint")


def middle_high(n: Column) -> Column:
    return F.floor(n / 2).cast("bigint")


def long_values(df: DataFrame, group: list[str], columns: dict[str, Column]) -> DataFrame:
    """(group, column, v) for several numeric columns in one scan, nulls dropped."""
    items = F.array(*[F.struct(F.lit(k).alias("column"), c.cast("double").alias("v")) for k, c in columns.items()])
    return df.select(*group, F.inline(items)).filter(F.col("v").isNotNull())


def _locate(counts: DataFrame, by: list[str], order: str, ranks: Column, most: int, counted: bool = False) -> DataFrame:
    """Attach to each bucket the wanted ranks that fall into it, as an offset inside the bucket.

    At most ``most`` ranks are wanted. With ``counted`` they follow from the group's count, which is attached as ``_n``.
    """
    w = Window.partitionBy(*by)
    before = F.sum("cnt").over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("cnt")
    out = counts.withColumn("_before", before)
    if counted:
        out = out.withColumn("_n", F.sum("cnt").over(w))

    def held(k: Column) -> Column:
        return (k >= F.col("_before")) & (k < F.col("_before") + F.col("cnt"))
    hit = F.lit(False)
    for i in range(most):                       # few buckets hold a rank; only theirs are looked at one by one
        hit = hit | F.coalesce(held(F.get(ranks, F.lit(i))["k"]), F.lit(False))
    return out.where(hit).withColumn("_inside", F.transform(F.filter(ranks, lambda r: held(r["k"])), lambda r: F.struct(
        r["name"].alias("name"), (r["k"] - F.col("_before")).alias("k"))))


def sketch(v: str | Column = "v") -> Column:
    """Mergeable sketch of a column's distribution."""
    return F.kll_sketch_agg_double(v, F.lit(SKETCH_K))


def _inside(rows: DataFrame, zones: DataFrame, by: list[str]) -> DataFrame:
    """Rows that lie in one of the zones of their group, with the zone's columns."""
    return same_group(rows, zones, by).where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))


def exact_ranks(values: DataFrame, group: list[str], ranks: dict[str, object], one_job: bool = False,
                weight: str | None = None, sketches: DataFrame | None = None, bound: int = BOUND) -> DataFrame:
    """Value at each named rank per (group, column).

    ``values`` has the group columns, ``column`` and a double ``v``, and with ``weight`` stands for that many rows; ``ranks``
    maps a name to a function from the group's value count to a zero-based rank. ``sketches`` (group, column, sketch) spares the first
    sketching scan. Output: group, column, name, value.
    """
    by = [*group, "column"]
    w = F.sum(weight) if weight else F.count(F.lit(1))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), fn(F.col("_n")).alias("k")) for name, fn in ranks.items()])
    rows = values.select(*by, "v", *([weight] if weight else []))
    single = F.col(weight) if weight else F.lit(1).cast("bigint")
    if one_job:
        counts = rows.groupBy(*by, "v").agg(w.alias("cnt"))
        return _read_off(_locate(counts, by, "v", wanted, len(ranks), counted=True), by)
    zones = rows.groupBy(*by).agg(w.alias("_n"), F.count(F.lit(1)).alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    zones = materialise(zones.withColumn("want", wanted).withColumnRenamed("_n", "cnt"), "zones")
    done, size = [], F.col("rows") > bound
    if zones.where(size).isEmpty():
        return _read_off(_locate(rows.select(*by, "v", single.alias("cnt")), by, "v", wanted, len(ranks), counted=True), by)
    open_zones = zones.where(size & (F.col("lo") < F.col("hi")))
    while not open_zones.isEmpty():
        done.append(zones.where(~size | (F.col("lo") >= F.col("hi"))))
        if sketches is None:
            known = _inside(rows, open_zones.select(*by, "lo", "hi"), by).groupBy(*by, "lo").agg(sketch().alias("sketch"))
            sketched = same_group(open_zones, known, [*by, "lo"])
        else:
            sketched, sketches = same_group(open_zones, sketches.select(*by, "sketch"), by), None
        grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
        at = F.transform("want", lambda r: F.floor(r["k"] / F.col("cnt") * GRID).cast("int"))
        ends = F.flatten(F.transform(at, lambda i: F.array(F.greatest(i - 1, F.lit(0)), F.least(i + 2, F.lit(GRID)))))
        edges = F.array_sort(F.array_distinct(F.transform(ends, lambda i: F.get(F.col("_grid"), i))))
        cut = materialise(sketched.withColumn("_grid", grid).withColumn("edges", edges).select(
            *by, "lo", "hi", "edges", "want"), "brackets")
        # an end is a zone of its own: a value on very many rows is singled out, and every round leaves less
        zone = F.size(F.filter("edges", lambda e: e < F.col("v"))) + F.size(F.filter("edges", lambda e: e <= F.col("v")))
        counted = _inside(rows, cut.select(*by, "lo", "hi", "edges"), by).groupBy(*by, "lo", zone.alias("zone")).agg(
            w.alias("cnt"), F.count(F.lit(1)).alias("rows"), F.min("v").alias("_min"), F.max("v").alias("_max"))
        counted = same_group(counted, cut.select(*by, "lo", "want"), [*by, "lo"])
        zones = materialise(_locate(counted, [*by, "lo"], "zone", F.col("want"), len(ranks)).select(
            *by, "cnt", "rows", F.col("_min").alias("lo"), F.col("_max").alias("hi"), F.col("_inside").alias("want")), "zones")
        open_zones = zones.where(size & (F.col("lo") < F.col("hi")))
    done.append(zones)
    last = done[0]
    for d in done[1:]:
        last = last.unionByName(d)
    flat = last.where("lo = hi").select(*by, F.explode("want").alias("_hit"), F.col("lo").alias("v")).select(
        *by, F.col("_hit")["name"].alias("name"), F.col("v").alias("value"))
    few = last.where("lo < hi")
    fine = _inside(rows, few.select(*by, "lo", "hi", "want"), by).withColumn("cnt", single)
    return flat.unionByName(_read_off(_locate(fine, [*by, "lo"], "v", F.col("want"), len(ranks)), by))


def _read_off(found: DataFrame, by: list[str]) -> DataFrame:
    return found.select(*by, F.explode("_inside").alias("_hit"), "v").select(
        *by, F.col("_hit")["name"].alias("name"), F.col("v").alias("value"))


def quantiles(values: DataFrame, group: list[str], qs: list[float], definition: str = "lower", one_job: bool = False,
              **how) -> DataFrame:
    """Exact quantiles, named by their probability."""
    rank = {"lower": lower_rank, "nearest": nearest_rank}[definition]
    return exact_ranks(values, group, {str(q): (lambda n, q=q: rank(q, n)) for q in qs}, one_job, **how)


def median(values: DataFrame, group: list[str]) -> DataFrame:
    """Mean of the two middle values."""
    mid = exact_ranks(values, group, {"low": middle_low, "high": middle_high})
    return mid.groupBy(*group, "column").agg(F.avg("value").alias("median"))


def approx_quantiles(df: DataFrame, group: list[str], column: str, qs: list[float], accuracy: int = 10_000) -> DataFrame:
    """One-pass sketch for informational figures."""
    return df.groupBy(*group).agg(F.percentile_approx(column, qs, accuracy).alias("quantiles"))
