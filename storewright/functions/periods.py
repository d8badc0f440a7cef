"""Reporting windows, as column expressions and for one Python date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

GRACE_DAYS = 3


def month_to_date_columns(day: Column) -> tuple[Column, Column]:
    """(start, end): month to date up to yesterday; up to day 3 the previous month still counts."""
    in_grace = F.dayofmonth(day) <= GRACE_DAYS
    start = F.when(in_grace, F.trunc(F.add_months(day, -1), "MM")).otherwise(F.trunc(day, "MM"))
    return start, F.date_sub(day, 1)


def previous_week_columns(day: Column) -> tuple[Column, Column]:
    """(Monday of last week, Monday of this week).

    The second date is returned as is: with an inclusive upper bound the span
    covers eight days.
    """
    since_monday = F.weekday(day)
    return F.date_sub(day, since_monday + 7), F.date_sub(day, since_monday)


def month_to_date_window(today: date) -> tuple[date, date]:
    """`month_to_date_columns` for one driver-side date, to fill a config."""
    yesterday = today - timedelta(days=1)
    month_of = today - timedelta(days=today.day) if today.day <= GRACE_DAYS else today
    return month_of.replace(day=1), yesterday


def previous_week_window(today: date) -> tuple[date, date]:
    """`previous_week_columns` for one driver-side date."""
    monday = today - timedelta(days=today.isoweekday() - 1)
    return monday - timedelta(weeks=1), monday
