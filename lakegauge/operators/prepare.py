"""Prepared columns: the frame the rules run on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.contract import Contract
from lakegauge.functions import numbers, times
from lakegauge.operators import rules

PART, PART_DATE = "_part", "_part_date"


def number_column(name: str) -> str:
    return f"_num_{name}"


def expected_column(flag: str) -> str:
    return f"_expect_{flag}"


def with_partition(df: DataFrame, part_date, label=None) -> DataFrame:
    """Mark every row with its logical partition: a date, and the label that identifies it."""
    d = part_date.cast("date")
    return df.withColumn(PART_DATE, d).withColumn(PART, d.cast("string") if label is None else label)


def prepare(df: DataFrame, c: Contract) -> DataFrame:
    """Add the derived columns a contract needs; unused ones are pruned by the optimizer."""
    types = {f.name: f.dataType for f in df.schema}
    floats = {n: numbers.no_nan(F.col(n), t) for n, t in types.items() if t.typeName() in ("double", "float")}
    out = df.withColumns(floats) if floats else df
    new = {number_column(k.name): numbers.as_number(F.col(k.name), types[k.name])
           for k in c.profiled_columns if k.name in types}
    for f in c.flags:
        flag, col, how = f.get("flag"), f.get("kolom"), f.get("aturan")
        if flag and how and col in types:
            if how == "ada":
                new[expected_column(flag)] = rules.present(F.col(col))
            elif how == "ada_dan_dalam_rentang":
                spec = c.column(col)
                new[expected_column(flag)] = rules.present_within(numbers.as_number(F.col(col), types[col]),
                                                                  spec.bounds if spec else None)
    out = out.withColumns(new) if new else out
    ev, ld = c.event_time, c.load_time
    if ev in types:
        out = out.withColumn(ev, times.as_time(F.col(ev), types[ev], c.epoch_unit))
        extra = {}
        if ld in types:
            out = out.withColumn(ld, times.as_time(F.col(ld), types[ld]))
            extra["_lag_days"] = times.lag_days(F.col(ev), F.col(ld))
        if c.grain in ("jam", "hari"):
            extra["_period"] = times.period(F.col(ev), c.grain)
            extra["_offgrid"] = times.off_grid_seconds(F.col(ev), c.grain)
            extra["_period_floor"] = times.period_floor(F.col(ev), c.grain)
        out = out.withColumns(extra) if extra else out
    return out
