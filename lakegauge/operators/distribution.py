"""Histograms, divergence from a baseline histogram, and z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.operators.order_stats import same_group

# Edge positions as fractions of the span; weight held back for tails and for empty bins.
EDGE_FRACTIONS = (0.0, 0.0001, 0.003, 0.013, 0.033, 0.066, 0.133, 0.333, 1.0)
TAIL_HOLDOUT = 0.01
EMPTY_HOLDOUT = 0.01


def edges(lo: float, hi: float) -> list[float]:
    """Bin edges that are dense near the lower end, for right-skewed measures."""
    if not lo < hi:
        return [lo, hi + 1.0]
    out = sorted({round(lo + f * (hi - lo), 6) for f in EDGE_FRACTIONS})
    return out if len(out) > 2 else [lo, (lo + hi) / 2, hi]


def bin_counts(x: Column, bins: list[float], prefix: str = "bin") -> dict[str, Column]:
    """One conditional count per bin (half-open, the last closed) plus both tails."""
    last = len(bins) - 2
    out = {f"{prefix}_below": F.count_if(x < bins[0])}
    for i, (a, b) in enumerate(zip(bins, bins[1:])):
        out[f"{prefix}_{i}"] = F.count_if((x >= a) & ((x <= b) if i == last else (x < b)))
    out[f"{prefix}_above"] = F.count_if(x > bins[-1])
    return out


def held_out_weights(weights: list[float]) -> list[float]:
    """Expected shares: inner weights shrunk by both holdouts, empty bins share one, the tails the other."""
    inner = [w * (1 - TAIL_HOLDOUT - EMPTY_HOLDOUT) for w in weights]
    empty = sum(w == 0 for w in inner)
    inner = [EMPTY_HOLDOUT / empty if w == 0 else w for w in inner]
    full = [TAIL_HOLDOUT / 2, *inner, TAIL_HOLDOUT / 2]
    total = sum(full)
    return [w / total for w in full]


def divergence(counts: list[Column], weights: list[float]) -> Column:
    """KL divergence of observed counts [below, bins..., above] from the baseline weights; null without values."""
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    out = F.lit(0.0)
    for c, q in zip(counts, held_out_weights(weights)):
        p = F.try_divide(c.cast("double"), total)
        out = out + F.when(c == 0, 0.0).otherwise(p * F.log(p / F.lit(q)))
    return F.when(total > 0, out)


def z_score(x: Column, mean: Column, sd: Column) -> Column:
    """Distance from the mean in standard deviations; zero where there is no spread."""
    return F.when(sd > 0, F.abs(x - mean) / sd).otherwise(F.when(x.isNotNull(), 0.0))


def z_outliers(df: DataFrame, group: list[str], columns: dict[str, Column], stats: DataFrame, threshold: float,
               mostly: float = 0.99) -> DataFrame:
    """Rows at or beyond the threshold per group and column.

    ``stats`` is the per-group table with ``<name>__mean`` and ``<name>__sd``; it has one row per
    group and is joined back on the group instead of a window over all rows of a group.
    """
    names = list(columns)
    joined = same_group(df.select(*group, *[c.alias(f"_x{i}") for i, c in enumerate(columns.values())]),
                        stats.select(*group, *[f"{n}__{s}" for n in names for s in ("mean", "sd")]), group)
    aggs = []
    for i, n in enumerate(names):
        z = z_score(F.col(f"_x{i}"), F.col(f"{n}__mean"), F.col(f"{n}__sd"))
        aggs += [F.count(f"_x{i}").alias(f"_t{i}"), F.count_if(z >= threshold).alias(f"_b{i}")]
    wide = joined.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *aggs)
    rows = [F.struct(F.lit(n).alias("column"), F.col("_n").alias("element_count"),
                     (F.col("_n") - F.col(f"_t{i}")).alias("missing_count"),
                     F.col(f"_b{i}").alias("unexpected_count"),
                     F.try_divide(F.col(f"_b{i}") * 100.0, F.col(f"_t{i}")).alias("unexpected_percent"),
                     F.coalesce(F.try_divide(F.col(f"_t{i}") - F.col(f"_b{i}"), F.col(f"_t{i}")) >= mostly,
                                F.lit(True)).alias("success")) for i, n in enumerate(names)]
    return wide.select(*group, F.inline(F.array(*rows)))


def value_shares(df: DataFrame, group: list[str], column: str) -> DataFrame:
    """Share of each value of a category within its group."""
    counts = df.groupBy(*group, column).agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy(*group).agg(F.sum("rows").alias("total"))
    return same_group(counts, totals, group).withColumn("share", F.col("rows") / F.col("total"))


def ratio_within(df: DataFrame, group: list[str], column: str, expected: float, tolerance: float) -> DataFrame:
    """Share of true rows among the non-null ones against an expected share."""
    share = F.avg(F.col(column).cast("int"))
    return df.groupBy(*group).agg(F.count(column).alias("element_count"), share.alias("observed_num")).withColumn(
        "success", F.coalesce(F.abs(F.col("observed_num") - expected) <= tolerance, F.lit(True)))
