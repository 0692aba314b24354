"""Dates as partition values, paths and ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_DATE_CHARS = 8  # shorter bounds count as absent ("2024-1-5" is the shortest date)


def date_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def is_previous_day(day: Column, as_of: dt.date | Column) -> Column:
    """True for the partition of the day before ``as_of``; a constant bound prunes partitions."""
    bound = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return day == F.date_sub(bound, 1)


def date_path(root: str | Column, day: Column, file_name: Column) -> Column:
    """``root/YYYY/MM/DD/file``; NULL if a part is, as a shorter path would name something else."""
    root = root if isinstance(root, Column) else F.lit(root)
    return F.concat(root, F.date_format(day, "/yyyy/MM/dd/"), file_name)


def date_range(from_date: Column, to_date: Column) -> Column:
    """Every day between two text dates, both included, whichever comes first.

    An absent or too short bound gives an empty array. ``least`` and ``greatest`` skip NULLs, so
    the bounds are checked before they are compared.
    """
    usable = (F.length(from_date) >= MIN_DATE_CHARS) & (F.length(to_date) >= MIN_DATE_CHARS)
    first = F.when(usable, F.to_date(from_date, "yyyy-M-d"))
    last = F.when(usable, F.to_date(to_date, "yyyy-M-d"))
    days = F.sequence(F.least(first, last), F.greatest(first, last), F.expr("interval 1 day"))
    return F.coalesce(F.when(usable, days), F.array().cast("array<date>"))


def in_previous_day(moment: Column, as_of: dt.date) -> Column:
    """The same for a timestamp column, as two bounds that reach the file scan's statistics."""
    # Text literals: a Python datetime would be read in the driver's own time zone.
    midnight = [F.lit(f"{day} 00:00:00").cast("timestamp_ntz") for day in (as_of - dt.timedelta(days=1), as_of)]
    return (moment >= midnight[0]) & (moment < midnight[1])
