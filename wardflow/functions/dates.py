"""Date differences that count crossed boundaries. None of them depends on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: dt.date | str | Column | None) -> Column:
    """A reference day given as date, text or column; today where it is missing."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def as_timestamp(value: dt.datetime | str | Column | None) -> Column:
    """A point in time without zone; now where it is missing."""
    if value is None:
        return F.localtimestamp()
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def year_boundaries(start: Column, end: Column) -> Column:
    """Number of new years between two dates, not full years of age."""
    return F.year(end) - F.year(start)


def day_boundaries(start: Column, end: Column) -> Column:
    """Number of midnights between two dates or timestamps."""
    return F.date_diff(F.to_date(end), F.to_date(start))


def hour_floor(ts: Column) -> Column:
    """The timestamp at the start of its hour, as a timestamp without zone."""
    ts = ts.cast("timestamp_ntz")
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, F.extract(F.lit("MINUTE"), ts), F.extract(F.lit("SECOND"), ts))


def second_boundaries(start: Column, end: Column) -> Column:
    """Number of full clock seconds passed between two timestamps, counted at the tick."""
    return _whole_seconds(end) - _whole_seconds(start)


def _whole_seconds(ts: Column) -> Column:
    ts = ts.cast("timestamp_ntz")
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + clock


def within_minutes(ts: Column, minutes: int, now: dt.datetime | str | Column | None = None) -> Column:
    """True for times later than now minus the given minutes."""
    return ts > as_timestamp(now) - F.make_dt_interval(mins=F.lit(minutes))
