"""SQL predicates, kept apart: what one raises at run time is its own finding, in the partition where it happens."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.operators import onepass, rules
from lakegauge.session import materialise, together

_OUT = ("rule_id", "element_count", "missing_count", "unexpected_count", "unexpected_percent", "success")


def message(failed: Exception) -> str:
    """First line of what went wrong, with its error class."""
    return str(failed).strip().splitlines()[0][:500] or type(failed).__name__


def _counted(df: DataFrame, group: list[str], predicates: list[rules.RowRule]) -> DataFrame:
    return materialise(onepass.grouped_checks(df, group, predicates).withColumn("error", F.lit(None).cast("string")), "predicates")


def isolated(df: DataFrame, group: list[str], predicates: list[rules.RowRule], partitions: DataFrame) -> DataFrame:
    """Counts of each predicate per partition; a division by zero, an overflow or a bad cast is a failed row with its error.

    All predicates are counted in one job. Only if it fails they are tried one by one, and one that fails is tried
    on halves of the partitions until those are left alone in which it can't be evaluated: each round of halves reads
    the table at most once. ``partitions`` (the columns of ``group``) are those that hold rows; ``group[0]`` identifies them.
    """
    try:
        return _counted(df, group, predicates)
    except (PySparkException, Py4JError):
        if len(predicates) > 1:
            tried = together(**{r.rule_id: (lambda r=r: isolated(df, group, [r], partitions)) for r in predicates})
            return _union(list(tried.values()))
    (rule,) = predicates
    known = [r[0] for r in partitions.select(group[0]).distinct().orderBy(group[0]).collect()]
    good, bad, halves = [], {}, _split(known)
    while halves:
        results = together(**{str(i): (lambda h=h: _attempt(df, group, rule, h)) for i, h in enumerate(halves)})
        again = []
        for i, h in enumerate(halves):
            got = results[str(i)]
            if isinstance(got, DataFrame):
                good.append(got)
            elif len(h) == 1:
                bad[h[0]] = got
            else:
                again += _split(h)
        halves = again
    if bad:
        said = F.coalesce(*[F.when(F.col(group[0]).eqNullSafe(F.lit(p)), F.lit(e)) for p, e in bad.items()])
        good.append(partitions.select(*group).distinct().withColumn("error", said).where("error IS NOT NULL").select(
            *group, F.lit(rule.rule_id).alias("rule_id"), *[F.lit(None).cast("bigint").alias(n) for n in _OUT[1:4]],
            F.lit(None).cast("double").alias("unexpected_percent"), F.lit(False).alias("success"), "error"))
    return _union(good)


def _split(parts: list) -> list[list]:
    return [h for h in (parts[:len(parts) // 2], parts[len(parts) // 2:]) if h]


def _attempt(df: DataFrame, group: list[str], rule: rules.RowRule, parts: list) -> DataFrame | str:
    named = [p for p in parts if p is not None]
    mine = F.col(group[0]).isin(*named) if named else F.lit(False)
    if len(named) < len(parts):
        mine = mine | F.col(group[0]).isNull()
    try:
        return _counted(df.where(mine), group, [rule])
    except (PySparkException, Py4JError) as failed:
        return message(failed)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
