"""Event time, partition windows and dates read from paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Micros per epoch unit of the contract format (nanoseconds divide).
_EPOCH_MICROS = {"detik": 1_000_000, "milidetik": 1_000, "mikrodetik": 1}


def from_epoch(col: Column, unit: str) -> Column:
    """An epoch number as a time without zone."""
    n = col.cast("bigint")
    if unit == "nanodetik":     # whole-number division: a double would lose the last digits
        micros = F.call_function("div", n - F.pmod(n, F.lit(1000)), F.lit(1000))
    else:
        micros = n * F.lit(_EPOCH_MICROS[unit])
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def micros_of(ts: Column) -> Column:
    """Microseconds since 1970 of a time without zone, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", _epoch(), ts)


def as_time(col: Column, dtype: T.DataType, unit: str | None = None) -> Column:
    """Any time-like column as a UTC time without zone; plain numbers are epochs (ns unless a unit says otherwise)."""
    if isinstance(dtype, T.NumericType):
        return from_epoch(col, unit or "nanodetik")
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(col).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(col), _epoch())
    return col.cast("timestamp_ntz")


def lag_days(event: Column, load: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", event, load) / F.lit(86_400_000_000.0)


def period(ts: Column, grain: str) -> Column:
    return F.hour(ts) if grain == "jam" else F.dayofmonth(ts)


def period_floor(ts: Column, grain: str) -> Column:
    return F.date_trunc("hour" if grain == "jam" else "day", ts).cast("timestamp_ntz")


def off_grid_seconds(ts: Column, grain: str) -> Column:
    return F.timestamp_diff("MICROSECOND", period_floor(ts, grain), ts) / F.lit(1e6)


def window_start(part_date: Column, offset_hours: float = 0.0) -> Column:
    start = part_date.cast("timestamp_ntz")
    return start + F.make_dt_interval(mins=F.lit(int(round(offset_hours * 60)))) if offset_hours else start


def window_end(start: Column, days: int = 1) -> Column:
    """Last microsecond of the window."""
    return start + F.expr(f"INTERVAL {days} DAYS") - F.expr("INTERVAL '0.000001' SECOND")


def week_of_month(d: Column) -> Column:
    return (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("int")


def week_start(d: Column) -> Column:
    """Representative date of a week-of-month partition: day 1, 8, 15, 22 or 29."""
    return F.make_date(F.year(d), F.month(d), (F.lit(1) + (week_of_month(d) - 1) * 7).cast("int"))


def _digits(path: Column, pattern: str, *groups: int) -> list[Column]:
    return [F.regexp_extract(path, pattern, g) for g in groups]


def _valid_date(y: Column, m: Column, d: Column) -> Column:
    text = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


#: folders that name a date, as keys of key=value folders
DATED_FOLDERS = {"day": ("recorded_year", "recorded_month", "recorded_day"),
                 "week": ("recorded_year", "recorded_month", "recorded_week"), "snapshot": ("snapshot_date",)}


def date_from_folders(layout: str) -> Column:
    """Partition date from the values of its folders, which a scan supplies as constant columns."""
    v = [F.col(k) for k in DATED_FOLDERS[layout]]
    if layout == "snapshot":
        return v[0].try_cast("date")
    if layout == "day":
        return _valid_date(*v)
    n = F.ltrim(v[2], F.lit("Ww")).try_cast("int")
    return _valid_date(v[0], v[1], (F.lit(1) + (n - 1) * 7).cast("string"))


def layout_of(path: Column) -> Column:
    """Which of ``DATED_FOLDERS`` a path has, as whole folders in a row; null otherwise."""
    d = r"/recorded_year=\d{4}/recorded_month=\d{2}/"
    return (F.when(path.rlike(d + r"recorded_day=\d{1,2}/"), "day").when(path.rlike(d + r"recorded_week=[Ww]?\d{1,2}/"), "week")
            .when(path.rlike(r"/snapshot_date=\d{4}-\d{2}-\d{2}/") & ~path.rlike("(?i)recorded_year="), "snapshot"))


def date_from_path(path: Column) -> Column:
    """Partition date named by a path; null when it names none or an impossible one.

    The first layout that occurs decides: day folders, week-of-month folders, snapshot
    folder, eight digits in the file name.
    """
    p = F.regexp_replace(path, r"\\", "/")
    day = r"recorded_year=(\d{4})/recorded_month=(\d{2})/recorded_day=(\d{1,2})"
    week = r"(?i)recorded_year=(\d{4})/recorded_month=(\d{2})/recorded_week=W?(\d{1,2})"
    snap = r"snapshot_date=(\d{4})-(\d{2})-(\d{2})"
    wy, wm, wn = _digits(p, week, 1, 2, 3)
    n = wn.try_cast("int")
    week_day = F.when(n.between(1, 5), (F.lit(1) + (n - 1) * 7).cast("string"))
    base = F.regexp_extract(p, r"([^/]*)$", 1)
    return (F.when(p.rlike(day), _valid_date(*_digits(p, day, 1, 2, 3)))
            .when(p.rlike(week), F.when(week_day.isNotNull(), _valid_date(wy, wm, week_day)))
            .when(p.rlike(snap), _valid_date(*_digits(p, snap, 1, 2, 3)))
            .when(base.rlike(r"\d{8}"), _valid_date(*_digits(F.regexp_extract(base, r"(\d{8})", 1),
                                                             r"^(\d{4})(\d{2})(\d{2})$", 1, 2, 3))))


def distinct_periods(number: Column) -> Column:
    """Aggregate: how many different hours or days of month occur. They fit a bit set, so no distinct shuffle."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.cast("int"))
    return F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).cast("bigint")
