"""Date arithmetic in days. All functions take and return columns."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def stamp(col: Column) -> Column:
    """Wall-clock timestamp without zone, so day arithmetic is free of DST."""
    return col.cast("timestamp_ntz")


def day(value: dt.date) -> Column:
    return F.lit(value).cast("date")


def day_offset(as_of: dt.date, days: int) -> Column:
    return day(as_of + dt.timedelta(days=days))


def month_end(as_of: dt.date) -> Column:
    """Last second of the month of ``as_of``; valid in December too."""
    last = calendar.monthrange(as_of.year, as_of.month)[1]
    return F.lit(dt.datetime(as_of.year, as_of.month, last, 23, 59, 59)).cast("timestamp_ntz")


def month_end_of(col: Column) -> Column:
    """Last second of the month of each row's date."""
    return stamp(F.date_add(F.last_day(col), 1)) - F.expr("INTERVAL '1' SECOND")


def _second_of_day(col: Column) -> Column:
    # The type is known when planning, so for dates this folds to zero.
    clock = F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
    return F.when(F.typeof(col) == "date", F.lit(0)).otherwise(clock)


def days_between(end: Column, start: Column) -> Column:
    """``end - start`` in days as a double, by wall clock. Inputs may carry a time of day."""
    return F.datediff(end, start).cast("double") + (
        _second_of_day(end) - _second_of_day(start)
    ) / F.lit(86400.0)


def whole_days(end: Column, start: Column) -> Column:
    """Days between two dates rounded down, also for negative spans."""
    return F.floor(days_between(end, start))


def add_days(date: Column, days: Column) -> Column:
    """Shift by a fractional number of days, to the millisecond."""
    millis = F.floor(days * 86_400_000.0 + 0.5).cast("bigint")
    return F.timestamp_add("MILLISECOND", millis, stamp(date))


def midnight(col: Column) -> Column:
    return F.date_trunc("day", col)


def epoch_days(col: Column) -> Column:
    return days_between(col, F.lit(dt.date(1970, 1, 1)))
