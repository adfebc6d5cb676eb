"""Date and time helpers. The session zone is UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _stamp(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed seconds with their fraction."""
    return (F.unix_micros(_stamp(end)) - F.unix_micros(_stamp(start))) / F.lit(1e6)


def boundary_minutes(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed: 10:00:59 to 10:01:01 gives 1."""
    first = F.floor(F.unix_seconds(_stamp(start)) / 60)
    last = F.floor(F.unix_seconds(_stamp(end)) / 60)
    return (last - first).cast("bigint")


def elapsed_minutes(start: Column | str, end: Column | str) -> Column:
    """Whole minutes elapsed: 10:00:59 to 10:01:01 gives 0."""
    return F.timestamp_diff("MINUTE", _stamp(start), _stamp(end)).cast("bigint")


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    return (F.unix_timestamp(_stamp(end)) - F.unix_timestamp(_stamp(start))) / F.lit(3600)


def weekday_from_zero(c: Column | str) -> Column:
    """0 is Sunday."""
    return F.dayofweek(c) - 1


def weekday_from_one(c: Column | str) -> Column:
    """1 is Sunday."""
    return F.dayofweek(c)


def month_start(c: Column | str) -> Column:
    return F.date_trunc("month", c)


def within(c: Column, start: str, end: str) -> Column:
    """Half-open range, written so that it reaches the file scan."""
    return (c >= F.lit(start).cast("timestamp")) & (c < F.lit(end).cast("timestamp"))


def month_range(year: int, month: int) -> tuple[str, str]:
    later = (year + 1, 1) if month == 12 else (year, month + 1)
    return f"{year:04d}-{month:02d}-01", f"{later[0]:04d}-{later[1]:02d}-01"


def on_day(c: Column, day: str) -> Column:
    """Rows of one day as a range predicate, which file statistics can answer."""
    first = F.lit(day).cast("timestamp")
    return (c >= first) & (c < first + F.expr("INTERVAL 1 DAY"))


def parse_stamp(c: Column | str) -> Column:
    """Text to timestamp; unparsable text gives NULL."""
    return F.try_to_timestamp(c, F.lit(STAMP_FORMAT))
