"""Column helpers that pin down rounding, division, hours and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(value: str | Column, digits: int = 0) -> Column:
    """Round the binary value half away from zero.

    ``F.round(x, n)`` works on the shortest decimal text of x, so 1.005 becomes
    1.01. Scaling first keeps the result that double arithmetic gives: 1.00.
    """
    scale = F.lit(float(10**digits))
    return F.round(col(value) * scale) / scale


def ratio(part: str | Column, whole: str | Column) -> Column:
    """part / whole as a double; unknown when the whole is zero or unknown."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double"))


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    return round_half_away(ratio(part, whole) * F.lit(100.0), digits)


def month_of(timestamp: str | Column) -> Column:
    """First day of the calendar month, as a date."""
    return F.trunc(F.to_date(col(timestamp)), "MM")


def month_index(month: str | Column) -> Column:
    """Months counted from year 0, so neighbouring months differ by one."""
    return F.year(col(month)) * 12 + F.month(col(month))


def _clock_hour(timestamp: str | Column) -> Column:
    """Running number of the clock hour; on zone-less timestamps no zone is involved."""
    return F.floor(F.unix_timestamp(col(timestamp)) / F.lit(3600.0))


def hour_boundaries(start: str | Column, end: str | Column) -> Column:
    """Clock hours crossed between two timestamps (10:59 to 12:01 is 2)."""
    return _clock_hour(end) - _clock_hour(start)


def days_between_hours(start: str | Column, end: str | Column) -> Column:
    """Crossed clock hours expressed in days."""
    return hour_boundaries(start, end).cast("double") / F.lit(24.0)


def elapsed_hours(start: str | Column, end: str | Column) -> Column:
    """Fractional hours between two timestamps; negative if they are reversed."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)).cast("double") / F.lit(3.6e9)


def parse_timestamp(text: str | Column) -> Column:
    """Text to a zone-less timestamp; text that is no timestamp becomes unknown.

    ``sources.checked`` lists such cells, and the jobs refuse them.
    """
    return col(text).try_cast("timestamp_ntz")
