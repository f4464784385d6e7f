"""The expected payment of one recurrence on one day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_due(day: Column, begin: Column, last_payment: Column, delta: Column, delta_sd: Column,
           sd_factor: int = 2) -> Column:
    """Whether a recurrence with mean gap ``delta`` is expected on ``day``.

    ``u`` is the position of ``day`` in the payment cycle counted from the last
    payment (``pmod``: also right for days before the last payment); a cycle
    position of 0 counts as a full cycle. The payment is placed
    ``int(sd_factor * sd)`` days before the mean due day; on the first day of the
    horizon it also collects payments that are due within the spread or were due
    within the spread.
    """
    cycle = delta.cast("double")
    spread = F.lit(float(sd_factor)) * delta_sd.cast("double")
    position = F.pmod(F.datediff(day, last_payment).cast("double"), cycle)
    position = F.when(position == 0, cycle).otherwise(position)
    days_to_next = (cycle - position).cast("int")
    first_day = day == begin
    return (
        (days_to_next == spread.cast("int"))
        | (first_day & (days_to_next < spread))
        | (first_day & (days_to_next >= cycle - spread))
    )


def expected_payment(day: Column, begin: Column, amount: Column, last_payment: Column,
                     delta: Column, delta_sd: Column, sd_factor: int = 2) -> Column:
    """Amount expected on ``day`` from a recurrence, 0 on days it is not due."""
    due = is_due(day, begin, last_payment, delta, delta_sd, sd_factor)
    return F.when(due, amount.cast("float")).otherwise(F.lit(0.0).cast("float"))


def due_days(begin: date, end: date, last_payment: Column, delta: Column, delta_sd: Column,
             sd_factor: int = 2) -> Column:
    """The days of ``[begin, end)`` on which a recurrence is due, as an array.

    A payment falls on one day a cycle: the last day at least
    ``int(sd_factor * sd)`` days before the cycle's end. So one day for each cycle
    that meets the horizon is computed, with its neighbours (a mean gap is a
    fraction), and tested by ``is_due``; the first day is tested too. The work
    grows with the payments due, not with the days of the horizon. Cycles of less
    than a day test every day.
    """
    cycle = delta.cast("double")
    ahead = (F.lit(float(sd_factor)) * delta_sd.cast("double")).cast("int")
    first, last = F.datediff(F.lit(begin), last_payment), F.datediff(F.lit(end), last_payment) - 1
    cycles = F.sequence(F.floor(first / cycle) - 1, F.floor(last / cycle) + 3)
    near = F.flatten(F.transform(cycles, lambda k: F.transform(
        F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda off: (F.floor(k * cycle) - ahead).cast("int") + off)))
    days = F.when(cycle >= 1, F.concat(F.array(first), near)).otherwise(F.sequence(first, last))
    within = F.filter(F.array_distinct(days), lambda d: (d >= first) & (d <= last))
    dates = F.transform(within, lambda d: F.date_add(last_payment, d))
    return F.filter(dates, lambda day: is_due(day, F.lit(begin), last_payment, delta, delta_sd, sd_factor))
