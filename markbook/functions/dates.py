"""Date anchors of a report run (FN1-FN6), as Column expressions.

All of them take a DateType column, so one expression serves a single as-of
literal and a column of many as-of dates (backfill, EXT2) alike.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def previous_weekday(d) -> Column:
    """FN3: Monday goes back 3 days, Sunday 2, any other day 1 (no holidays, Q4).

    ``weekday`` is 0 for Monday .. 6 for Sunday (not ``dayofweek``, 1 = Sunday).
    """
    d = _col(d)
    wd = F.weekday(d)
    return (F.when(wd == 0, F.date_sub(d, 3))
            .when(wd == 6, F.date_sub(d, 2))
            .otherwise(F.date_sub(d, 1)))


def previous_weekday_of(d: dt.date) -> dt.date:
    """Driver-side twin of :func:`previous_weekday` for one literal date
    (tests check both agree)."""
    wd = d.weekday()
    return d - dt.timedelta(days=3 if wd == 0 else 2 if wd == 6 else 1)


def beginning_of_year_of(d: dt.date) -> dt.date:
    """Driver-side twin of :func:`beginning_of_year`."""
    return dt.date(d.year, 1, 2)


def beginning_of_year(d) -> Column:
    """FN4: first day of the year plus one day, i.e. 2 January (a date)."""
    return F.date_add(F.trunc(_col(d), "year"), 1)


def previous_day(d) -> Column:
    """FN6: previous calendar day (the lake run's default as-of)."""
    return F.date_sub(_col(d), 1)


def local_date(ts, zone: str) -> Column:
    """FN1/FN2: calendar date in ``zone`` of a UTC wall-clock timestamp.

    The timestamp is read as UTC wall-clock time (``timestamp_ntz``; a
    session-zone timestamp is first taken at its wall-clock value) and
    converted with ``convert_timezone``, so the result does not depend on the
    session time zone.  A region id such as ``America/Los_Angeles`` follows
    daylight saving; a fixed offset such as ``-08:00`` does not (the
    warehouse's ``'pst'``).
    """
    wall = _col(ts).cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), wall))


def today_in(zone: str) -> Column:
    """FN1: today's date in ``zone`` (prefer injecting an explicit as-of).
    ``current_timestamp`` is an instant; its wall-clock value is in the
    session zone, which is therefore the conversion's source zone."""
    wall = F.current_timestamp().cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(None, F.lit(zone), wall))
