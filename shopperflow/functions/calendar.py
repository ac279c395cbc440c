"""Dates, periods and elapsed time.

Months and quarters travel through joins and groupings as plain integers, so period
arithmetic is a subtraction; labels are made only once the rows are few.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Moment = dt.date | dt.datetime | str | None


def as_of(snapshot: Moment) -> Column:
    """The moment a report looks back from; now unless pinned."""
    if snapshot is None:
        return F.current_timestamp()
    if isinstance(snapshot, dt.date) and not isinstance(snapshot, dt.datetime):
        return F.lit(snapshot)
    return F.lit(str(snapshot)).cast("timestamp_ntz")


def calendar_days_since(column: Column, snapshot: Moment) -> Column:
    """Midnights crossed between `column` and the snapshot."""
    return F.datediff(as_of(snapshot).cast("date"), column.cast("date"))


def _time_of_day(moment: Column) -> Column:
    return F.date_format(moment.cast("timestamp_ntz"), "HHmmssSSSSSS")


def elapsed_days_since(column: Column, kind: T.DataType, snapshot: Moment) -> Column:
    """Whole days of elapsed time, rounded down (12 hours after the snapshot is -1).

    One day less than the calendar difference when the snapshot has not yet reached the column's
    time of day; a date column counts from midnight, so there the two agree.
    """
    days = calendar_days_since(column, snapshot)
    if isinstance(kind, T.DateType):
        return days
    return days - F.when(_time_of_day(column) > _time_of_day(as_of(snapshot)), 1).otherwise(0)


def month_index(column: Column) -> Column:
    return F.year(column) * 12 + F.month(column) - 1


def month_label(index: Column) -> Column:
    """'2024-03' from a month index."""
    return F.date_format(F.make_date(F.floor(index / 12).cast("int"), index % 12 + 1, F.lit(1)), "yyyy-MM")


def quarter_index(column: Column) -> Column:
    return F.year(column) * 4 + F.quarter(column) - 1


def quarter_label(index: Column) -> Column:
    """'2024Q2' from a quarter index."""
    return F.concat(F.floor(index / 4).cast("string"), F.lit("Q"), (index % 4 + 1).cast("string"))
