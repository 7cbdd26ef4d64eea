"""Dates and times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.constants import clock
from rowloom.functions.dateformat import format_date, parse_date, parse_timestamp, spark_pattern  # noqa: F401
from rowloom.functions.nulls import as_col

# Unit names and abbreviations.
_UNITS = {
    "year": ("year", "years", "yy", "yyyy"),
    "quarter": ("quarter", "quarters", "qq", "q"),
    "month": ("month", "months", "mm", "m"),
    "week": ("week", "weeks", "wk", "ww"),
    "day": ("day", "days", "dd", "d"),
    "hour": ("hour", "hours", "hh"),
    "minute": ("minute", "minutes", "mi", "n"),
    "second": ("second", "seconds", "ss", "s"),
    "millisecond": ("millisecond", "milliseconds", "ms"),
}
_UNIT_OF = {alias: unit for unit, aliases in _UNITS.items() for alias in aliases}

def unit_of(unit: str) -> str:
    """Full name of a date unit; abbreviations in any case."""
    name = _UNIT_OF.get(unit.lower())
    if name is None:
        raise ValueError(f"unknown date unit {unit!r}")
    return name


def now(run_at: dt.datetime | None = None) -> Column:
    """Time of the run: given, so that a run can be repeated, or the instant of the clock."""
    return clock(run_at) if run_at else F.current_timestamp()


def utc_now(run_at: dt.datetime | None = None) -> Column:
    """The UTC clock without a zone, whatever the zone of the session."""
    if run_at:
        return clock(run_at)
    seconds = (F.unix_micros(F.current_timestamp()) / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def today(run_at: dt.datetime | None = None) -> Column:
    return F.lit(run_at.date()) if run_at else F.current_date()


def add(value: Column | str, unit: str, n: int | Column) -> Column:
    """DATEADD and interval arithmetic. Months and years stop at the end of a shorter month."""
    n = n if isinstance(n, Column) else F.lit(n)
    value, unit = as_col(value), unit_of(unit)
    if unit == "quarter":
        return value + F.make_interval(months=n * 3)
    if unit == "millisecond":
        return value + F.make_interval(secs=n / 1000)
    part = {"second": "secs", "minute": "mins"}.get(unit, unit + "s")
    return value + F.make_interval(**{part: n})


def add_months(value: Column | str, n: int | Column) -> Column:
    """ADD_MONTHS: the last day of a month stays the last day of a month; a time of day stays."""
    value = as_col(value)
    date = value.cast("date")
    n = n if isinstance(n, Column) else F.lit(n)
    moved = F.add_months(date, n)
    more = F.when(date == F.last_day(date), F.datediff(F.last_day(moved), moved)).otherwise(0)
    return value + F.make_interval(months=n) + F.make_interval(days=more)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_col(end), as_col(start))


def boundaries_between(unit: str, start: Column | str, end: Column | str) -> Column:
    """DATEDIFF(unit, start, end): how many times the unit turns over, whole or not."""
    unit, start, end = unit_of(unit), as_col(start), as_col(end)
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    if unit == "year":
        return (F.year(end) - F.year(start)).cast("bigint")
    if unit == "quarter":
        return ((F.year(end) - F.year(start)) * 4 + F.quarter(end) - F.quarter(start)).cast("bigint")
    if unit == "month":
        return months.cast("bigint")
    if unit == "day":
        return F.datediff(end, start).cast("bigint")
    if unit == "week":
        # weeks turn over on Sunday, whatever the session says
        def sunday(c: Column) -> Column:
            return F.date_sub(c.cast("date"), F.dayofweek(c) - 1)

        return (F.datediff(sunday(end), sunday(start)) / 7).cast("bigint")
    return _clock(end, unit) - _clock(start, unit)


def _clock(value: Column, unit: str) -> Column:
    """Units on the clock since 1970, read from the fields of the value and so free of time zones."""
    ticks = F.datediff(value, F.lit(dt.date(1970, 1, 1))).cast("bigint") * 24 + F.hour(value)
    if unit != "hour":
        ticks = ticks * 60 + F.minute(value)
    if unit in ("second", "millisecond"):
        ticks = ticks * 60 + F.second(value)
    if unit == "millisecond":
        fraction = F.date_part(F.lit("second"), value) - F.second(value)
        ticks = ticks * 1000 + F.floor(fraction * 1000)
    return ticks


def months_between(end: Column | str, start: Column | str) -> Column:
    """Whole months where both are the same day or month ends, else a fraction of 31 days."""
    return F.months_between(as_col(end), as_col(start))


def part(unit: str, value: Column | str) -> Column:
    return F.date_part(F.lit(unit_of(unit)), as_col(value)).cast("int")


def part_name(unit: str, value: Column | str) -> Column:
    """DATENAME: month and weekday by name, other parts as text."""
    if unit.lower() in ("weekday", "dw"):
        return F.date_format(as_col(value), "EEEE")
    if unit_of(unit) == "month":
        return F.date_format(as_col(value), "MMMM")
    return part(unit, value).cast("string")


def epoch_seconds(value: Column | str) -> Column:
    """Seconds since 1970 of a time on the UTC clock."""
    return _clock(as_col(value), "second")


def truncate(value: Column | str, unit: str) -> Column:
    """TRUNC for dates."""
    return F.date_trunc(unit_of(unit), as_col(value))


def compare(a: Column | str, b: Column | str) -> Column:
    """-1, 0 or 1 as the first time is before, at or after the second."""
    a, b = as_col(a), as_col(b)
    return F.when(a < b, -1).when(a > b, 1).when(a == b, 0)
