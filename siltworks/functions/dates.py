"""Periods, keys and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31 00:00:00"


def open_end() -> Column:
    """The end of a version that is still valid."""
    return F.lit(OPEN_END).cast("timestamp_ntz")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def period_from_name(name: Column, pattern: str = r"(\d{4}-\d{2})") -> Column:
    """First day of the month a file name claims; null if it claims none.

    Casting ISO text is several times faster than parsing it by a date pattern.
    """
    return F.concat(F.regexp_extract(name, pattern, 1), F.lit("-01")).try_cast("date")


def outside_period(ts: Column, period: Column) -> Column:
    """True unless ``ts`` lies in ``[period, period + 1 month)``; null without a period.

    ``period`` is the first day of a month, so one comparison of months decides; the period, which
    may be costly to find, is evaluated once.
    """
    return F.trunc(ts.cast("date"), "month") != period


def half_open(ts: Column, start: Column, end: Column) -> Column:
    return (ts >= start) & (ts < end)


def date_key(ts: Column) -> Column:
    """20230315 for any instant of that day."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def month_text(ts: Column) -> Column:
    """2023-03 for any instant of that month."""
    return F.concat_ws("-", F.lpad(F.year(ts).cast("string"), 4, "0"), F.lpad(F.month(ts).cast("string"), 2, "0"))


def minutes_between(start: Column, end: Column, digits: int = 2) -> Column:
    """Whole seconds between two instants, in minutes."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds / F.lit(60.0), digits)
