"""Date expressions (all native Catalyst expressions, no Python at run time)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> Column:
    """A date literal from a ``date`` or an ISO string, or a column; the time of day
    is cut off."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, datetime):
        value = value.date()
    if isinstance(value, date):
        return F.lit(value)
    return F.lit(str(value)).cast("date")


def months_before(reference: Column, months: int) -> Column:
    """``reference`` minus ``months`` calendar months, clipped to the month end
    (2017-05-31 minus 3 months is 2017-02-28)."""
    return F.add_months(reference, -months)


def horizon(last_payment: Column, sd_days: Column, mean_days: Column, sd_factor: int) -> Column:
    """Last payment plus ``sd_factor * int(sd) + int(mean)`` days.

    The standard deviation and the mean of the day gaps are truncated separately
    (toward zero) before they are added, as the original model does.
    """
    days = F.lit(sd_factor) * sd_days.cast("int") + mean_days.cast("int")
    return F.date_add(last_payment, days)


def horizon_days(begin: date, end: date) -> list[date]:
    """The dates of ``[begin, end)``; the driver only builds this list of
    column names for the wide calendar, its length is the horizon."""
    if begin >= end:
        raise ValueError(f"empty forecast horizon: begin {begin} is not before end {end}")
    return [begin + timedelta(days=i) for i in range((end - begin).days)]


def calendar_sequence(begin: date, end: date) -> Column:
    """Array of the dates of ``[begin, end)``, for ``explode``."""
    horizon_days(begin, end)
    return F.sequence(F.lit(begin), F.lit(end - timedelta(days=1)), F.expr("interval 1 day"))
