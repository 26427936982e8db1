"""Row rules: each says which rows are tested and which of those are bad."""

from __future__ import annotations

import datetime as dt
import decimal
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakegauge.functions import text, times


@dataclass
class RowRule:
    """One assertion about single rows.

    ``tested`` names the columns whose nulls take a row out of the test: null in all of them
    (pairs, compound keys) for ``skip="all"``, in any for ``skip="any"``, never for ``skip="never"``.
    """

    rule_id: str
    bad: Column
    tested: tuple[Column, ...] = ()
    tested_key: str = ""                 # equal keys share one count of missing rows
    skip: str = "any"
    value: Column | None = None          # shown in samples
    columns: tuple[str, ...] = ()        # columns read, keeps a chunk of rules on few columns
    mostly: float = 1.0
    meta: dict = field(default_factory=dict)

    @property
    def is_tested(self) -> Column:
        if self.skip == "never" or not self.tested:
            return F.lit(True)
        present = [c.isNotNull() for c in self.tested]
        out = present[0]
        for p in present[1:]:
            out = (out & p) if self.skip == "any" else (out | p)
        return out

    @property
    def is_bad(self) -> Column:
        return self.is_tested & F.coalesce(self.bad, F.lit(False))


def _one(rule_id: str, name: str, bad: Column, col: Column | None = None, **kw) -> RowRule:
    c = F.col(name) if col is None else col
    kw.setdefault("tested_key", name)
    return RowRule(rule_id, bad, (c,), value=c.cast("string"), columns=(name,), **kw)


def not_null(rule_id: str, name: str) -> RowRule:
    c = F.col(name)
    return RowRule(rule_id, c.isNull(), (), "*", "never", F.lit(None).cast("string"), (name,))


def between(rule_id: str, name: str, lo=None, hi=None, col: Column | None = None, **kw) -> RowRule:
    """Inclusive on both ends; an open end is None. Bounds may be literals or columns."""
    c = F.col(name) if col is None else col
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < lo)
    if hi is not None:
        bad = bad | (c > hi)
    return _one(rule_id, name, bad, c, **kw)


def length_between(rule_id: str, name: str, lo=None, hi=None) -> RowRule:
    n, c = F.length(F.col(name)), F.col(name)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (n < int(lo))
    if hi is not None:
        bad = bad | (n > int(hi))
    return _one(rule_id, name, bad, c)


def matches_any(rule_id: str, name: str, patterns: list[str]) -> RowRule:
    return _one(rule_id, name, ~text.finds_any(F.col(name), patterns))


def free_of(rule_id: str, name: str, pattern: str) -> RowRule:
    return _one(rule_id, name, text.finds(F.col(name), pattern))


def _kind(value) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float, decimal.Decimal)):
        return "double"
    return "timestamp_ntz" if isinstance(value, dt.date) else "string"


def _one_of(name: str, values: list) -> Column:
    """Whether a column is one of some literals, of any kinds: it is read as each kind, and what can't be is none of them."""
    c, out = F.col(name), F.lit(False)
    for kind in dict.fromkeys(map(_kind, (v for v in values if v is not None))):
        as_kind = c.cast("string").try_cast(kind) if kind != "boolean" else c.try_cast(kind)
        of_kind = [F.lit(float(v) if kind == "double" else v if kind == "boolean" else str(v)).cast(kind)
                   for v in values if v is not None and _kind(v) == kind]
        out = out | F.coalesce(as_kind.isin(*of_kind), F.lit(False))
    return out


def in_set(rule_id: str, name: str, allowed: list) -> RowRule:
    return _one(rule_id, name, ~_one_of(name, allowed))


def constant(rule_id: str, name: str, value) -> RowRule:
    return _one(rule_id, name, ~_one_of(name, [value]))


def in_window(rule_id: str, name: str, part_date: Column, days: int = 1, offset_hours: float = 0.0) -> RowRule:
    start = times.window_start(part_date, offset_hours)
    return between(rule_id, name, start, times.window_end(start, days))


def off_grid(rule_id: str, name: str, grain: str) -> RowRule:
    return _one(rule_id, name, times.off_grid_seconds(F.col(name), grain) != 0)


def lag_within(rule_id: str, event: str, load: str, days: float) -> RowRule:
    lag = times.lag_days(F.col(event), F.col(load))
    return RowRule(rule_id, ~lag.between(0, days), (F.col(event), F.col(load)), f"{event}&{load}", "any",
                   lag.cast("string"), (event, load))


def _pair(rule_id: str, a: Column, b: Column, names: tuple[str, ...], bad: Column) -> RowRule:
    return RowRule(rule_id, bad, (a, b), "|".join(names), "all",
                   F.concat_ws(" / ", F.coalesce(a.cast("string"), F.lit("null")),
                               F.coalesce(b.cast("string"), F.lit("null"))), names)


def equal(rule_id: str, a: str, b: str) -> RowRule:
    ca, cb = F.col(a), F.col(b)
    return _pair(rule_id, ca, cb, (a, b), ~ca.eqNullSafe(cb))


def at_least(rule_id: str, a: str, b: str) -> RowRule:
    ca, cb = F.col(a), F.col(b)
    return _pair(rule_id, ca, cb, (a, b), F.coalesce(ca < cb, F.lit(True)))


def flag_agrees(rule_id: str, flag: str, column: str, expected: Column) -> RowRule:
    f = F.col(flag)
    return RowRule(rule_id, ~f.eqNullSafe(expected), (), "*", "never",
                   F.coalesce(f.cast("string"), F.lit("null")), (flag, column))


def present(col: Column) -> Column:
    return col.isNotNull()


def present_within(number: Column, bounds: tuple | None) -> Column:
    if not bounds:
        return number.isNotNull()
    return F.coalesce(number.between(*bounds), F.lit(False))


def predicate(rule_id: str, expression: str, null_passes: bool = False) -> RowRule:
    """Any SQL condition; an unknown result counts as bad unless declared to pass."""
    e = F.expr(expression)
    return RowRule(rule_id, ~F.coalesce(e, F.lit(null_passes)), (), "*", "never",
                   F.lit(None).cast("string"), (expression,))
