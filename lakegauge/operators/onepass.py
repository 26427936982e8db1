"""All row rules and scalar metrics of a table in one grouped pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakegauge.operators.rules import RowRule

# Whole-stage codegen stops above spark.sql.codegen.maxFields (100) fields per operator.
SLOTS_PER_PASS = 80


def _chunks(rules: list[RowRule], slots: int) -> Iterator[list[RowRule]]:
    """Rules in passes that fit the codegen limit, neighbours by column so a pass reads few columns."""
    room, keys, out = slots, set(), []
    for r in sorted(rules, key=lambda r: (r.columns, r.rule_id)):
        need = 1 + (r.tested_key not in keys)
        if out and need > room:
            yield out
            room, keys, out = slots, set(), []
            need = 2
        out.append(r)
        keys.add(r.tested_key)
        room -= need
    if out:
        yield out


def grouped_checks(df: DataFrame, group: list[str], rules: Iterable[RowRule],
                   slots: int = SLOTS_PER_PASS) -> DataFrame:
    """Counts of every row rule per group: one partial aggregation, shuffled at group size.

    Output: group columns, rule_id, element_count, missing_count, unexpected_count,
    unexpected_percent (of the tested rows), success.
    """
    parts = [_one_pass(df, group, chunk) for chunk in _chunks(list(rules), slots)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rule_counts(rules: list[RowRule], weight: str | None = None) -> tuple[dict[str, Column], Callable[[DataFrame], DataFrame]]:
    """The aggregates that count a set of rules, and the step that turns one wide row per group into a row per rule.

    With a weight every input row stands for that many rows of its own column.
    """
    def count(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col(weight)).otherwise(0)) if weight else F.count_if(cond)

    aggs: dict[str, Column] = {} if weight else {"_n": F.count(F.lit(1))}
    alias: dict[str, str] = {}
    for r in rules:
        if r.tested_key not in alias:
            alias[r.tested_key] = "_n"
            if weight:
                aggs[f"_n_{len(alias)}"] = count(F.col("column") == r.columns[0])
            if r.skip != "never" and r.tested:
                name = f"_t{len(alias)}"
                aggs[name] = F.count(r.tested[0]) if len(r.tested) == 1 and not weight else count(r.is_tested)
                alias[r.tested_key] = name
    whole = {k: f"_n_{i}" if weight else "_n" for i, k in enumerate(alias, 1)}
    for i, r in enumerate(rules):
        aggs[f"_b{i}"] = count(r.is_bad)

    def unpivot(wide: DataFrame) -> DataFrame:
        rows = []
        for i, r in enumerate(rules):
            n, t, b = whole[r.tested_key], alias[r.tested_key], f"_b{i}"
            ok = f"{b} = 0" if r.mostly >= 1 else f"coalesce(try_divide({t} - {b}, {t}) >= {r.mostly}D, true)"
            rows.append(f"struct({i} AS _i, {n} AS element_count, {n} - {t} AS missing_count, {b} AS unexpected_count, "
                        f"try_divide({b} * 100.0D, {t}) AS unexpected_percent, {ok} AS success)")
        ids = F.array(*[F.lit(r.rule_id) for r in rules])
        keep = [c for c in wide.columns if c not in aggs]
        return wide.select(*keep, F.expr(f"inline(array({', '.join(rows)}))")).withColumn(
            "rule_id", F.element_at(ids, F.col("_i") + 1)).drop("_i")
    return aggs, unpivot


def _one_pass(df: DataFrame, group: list[str], rules: list[RowRule], weight: str | None = None) -> DataFrame:
    aggs, unpivot = rule_counts(rules, weight)
    out = unpivot(df.groupBy(*group).agg(*[v.alias(k) for k, v in aggs.items()]))
    return out.select(*group, "rule_id", "element_count", "missing_count", "unexpected_count", "unexpected_percent", "success")


def value_counts(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """(group, column, value, count) of text columns; folded on the map side."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("code")) for c in columns])
    return df.select(*group, F.inline(pairs)).groupBy(*group, "column", "code").agg(F.count(F.lit(1)).alias("_cnt"))


def checks_on_values(counts: DataFrame, group: list[str], rules: Iterable[RowRule], slots: int = SLOTS_PER_PASS) -> DataFrame:
    """Rules on single text columns, evaluated on value counts: a regular expression runs once per distinct value."""
    out = None
    for chunk in _chunks(list(rules), slots):
        cols = list(dict.fromkeys(r.columns[0] for r in chunk))
        own = counts.select(*group, "column", "_cnt", *[F.when(F.col("column") == c, F.col("code")).alias(c) for c in cols])
        part = _one_pass(own, group, chunk, "_cnt")
        out = part if out is None else out.unionByName(part)
    return out


def grouped_value_checks(df: DataFrame, group: list[str], rules: Iterable[RowRule], slots: int = SLOTS_PER_PASS) -> DataFrame:
    """The counts of ``grouped_checks`` for text columns with few values, by way of value counts."""
    rules = list(rules)
    return checks_on_values(value_counts(df, group, sorted({r.columns[0] for r in rules})), group, rules, slots)


def grouped_metrics(df: DataFrame, group: list[str], metrics: dict[str, Column]) -> DataFrame:
    """Scalar aggregates per group, one column each."""
    return df.groupBy(*group).agg(*[c.alias(k) for k, c in metrics.items()])


def samples(df: DataFrame, group: list[str], rules: Iterable[RowRule], k: int = 20) -> DataFrame:
    """Up to k offending values per group and rule, smallest first.

    ``row_number() <= k`` is pushed below the shuffle as a partial group limit, so a rule that
    fails on a third of the table still sends only k rows per task.
    """
    rules = list(rules)
    any_bad = rules[0].is_bad
    for r in rules[1:]:
        any_bad = any_bad | r.is_bad
    tests = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), r.is_bad.alias("_bad"), r.value.alias("value"))
                      for r in rules])
    bad = df.filter(any_bad).select(*group, F.inline(tests)).filter("_bad").drop("_bad")
    rank = F.row_number().over(Window.partitionBy(*group, "rule_id").orderBy(F.col("value").asc_nulls_last()))
    top = bad.withColumn("_rank", rank).filter(F.col("_rank") <= k)
    return top.groupBy(*group, "rule_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rank", "value"))), lambda s: s.value).alias("sample"))
