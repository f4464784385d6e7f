"""Forecast calendars: expected recurrent payments and the non-recurrent level.

The long shape (customer, date, amount) is the natural Spark table. A recurrence
becomes one row for each day on which it is due (``due_days``), which are summed
per customer and day; a customer's sums are folded into one row, from which the
long shape (all horizon days) and the wide one (one column per date, as the
original model returned) are read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.config import DEFAULT_CONFIG, RecurrenceConfig
from cadence.functions.dates import calendar_sequence, horizon_days
from cadence.functions.forecast import due_days, expected_payment
from cadence.operators.classify import NON_RECURRENT, RECURRENT
from cadence.operators.level import daily_level, monthly_percentile
from cadence.operators.patterns import MONTHS
from cadence.sources.schema import (
    CALENDAR_DATE, CUSTOMER, DELTA_AVG, DELTA_STD, EXPECTED_AMOUNT, IMP_OPER, MAX_FEC_TRANS, MAX_FECHA, MEAN_AMOUNT,
    MEAN_DIFF_DAYS, MONTH, MONTH_IM, SD_DIFF_DAYS, STATUS, SUM_IMPORTE, YEAR,
)

RECURRENT_KIND, LEVEL_KIND = "recurrent", "nonrecurrent"


def _expected(day, begin: date, config: RecurrenceConfig):
    return expected_payment(day, F.lit(begin), F.col(IMP_OPER), F.col(MAX_FEC_TRANS),
                            F.col(DELTA_AVG), F.col(DELTA_STD), config.sd_factor)


def expected_payments(recurrences: DataFrame, begin: date, end: date,
                      config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per recurrence and horizon day with the amount expected that day."""
    exploded = recurrences.select("*", F.explode(calendar_sequence(begin, end)).alias(CALENDAR_DATE))
    return exploded.select(CUSTOMER, CALENDAR_DATE,
                           _expected(F.col(CALENDAR_DATE), begin, config).alias(EXPECTED_AMOUNT))


def _dues(begin: date, end: date, config: RecurrenceConfig):
    """What a recurrence brings: (date, amount) for each day it is due, and one
    entry without a date, by which the recurrences are counted."""
    due = due_days(begin, end, F.col(MAX_FEC_TRANS), F.col(DELTA_AVG), F.col(DELTA_STD), config.sd_factor)
    amount = F.col(IMP_OPER).cast("float")
    none = F.struct(F.lit(None).cast("date").alias(CALENDAR_DATE), F.lit(None).cast("float").alias(EXPECTED_AMOUNT))
    return F.concat(F.transform(due, lambda d: F.struct(d.alias(CALENDAR_DATE), amount.alias(EXPECTED_AMOUNT))), F.array(none))


def _day_sums() -> list:
    return [F.sum(EXPECTED_AMOUNT).alias("_sum"), F.count(F.lit(1)).alias("_n"), F.count(EXPECTED_AMOUNT).alias("_known")]


def _folded() -> list:
    """The sums of a customer's days in one row, at most one entry a horizon day."""
    entry = F.struct(F.col(CALENDAR_DATE), F.struct("_sum", "_n", "_known"))
    return [F.map_from_entries(F.collect_list(F.when(F.col(CALENDAR_DATE).isNotNull(), entry))).alias("_due"),
            F.max(F.when(F.col(CALENDAR_DATE).isNull(), F.col("_n"))).alias("_recurrences")]


def _amount_on(day):
    """Expected amount of a folded row on a day: 0 from every recurrence that is not
    due. NULL only if all recurrences are due with an unknown amount."""
    due = F.try_element_at("_due", day)
    unknown = (due["_known"] == 0) & (due["_n"] == F.col("_recurrences"))
    return F.when(unknown, F.lit(None).cast("double")).otherwise(F.coalesce(due["_sum"], F.lit(0.0)))


def _by_customer(recurrences: DataFrame, begin: date, end: date, config: RecurrenceConfig) -> DataFrame:
    """One row per customer with the sums of the days on which something is due."""
    rows = recurrences.select(CUSTOMER, F.inline(_dues(begin, end, config)))
    return rows.groupBy(CUSTOMER, CALENDAR_DATE).agg(*_day_sums()).groupBy(CUSTOMER).agg(*_folded())


def recurrent_calendar(recurrences: DataFrame, begin: date, end: date,
                       config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Long calendar: expected recurrent amount per customer and day. Only due days
    are summed; the days without a payment come in once per customer."""
    days = _by_customer(recurrences, begin, end, config).select("*", F.explode(calendar_sequence(begin, end)).alias(CALENDAR_DATE))
    return days.select(CUSTOMER, CALENDAR_DATE, _amount_on(F.col(CALENDAR_DATE)).alias(EXPECTED_AMOUNT))


def recurrent_calendar_wide(recurrences: DataFrame, begin: date, end: date,
                            config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Wide calendar: one column per date named ``YYYY-MM-DD``."""
    days = _by_customer(recurrences, begin, end, config)
    return days.select(CUSTOMER, *[_amount_on(F.lit(d)).alias(str(d)) for d in horizon_days(begin, end)])


def both_calendars(patterns: DataFrame, begin: date, end: date, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """(customer, kind, date, amount) of both long calendars from one walk over the
    pattern table: a recurrence becomes rows of due days, a pattern that is not
    recurrent rows of its months, and one aggregate sums both kinds."""
    chosen = patterns.withColumns({IMP_OPER: F.col(MEAN_AMOUNT), MAX_FEC_TRANS: F.col(MAX_FECHA), DELTA_AVG: F.col(MEAN_DIFF_DAYS),
                                   DELTA_STD: F.col(SD_DIFF_DAYS)})
    month = chosen.schema[MONTHS].dataType.elementType

    def row(kind, day, amount, year, number, total):
        return F.struct(F.lit(kind).alias("kind"), day.cast("date").alias(CALENDAR_DATE), amount.cast("float").alias(EXPECTED_AMOUNT),
                        year.cast("int").alias(YEAR), number.cast("int").alias(MONTH),
                        total.cast(month[SUM_IMPORTE].dataType).alias(SUM_IMPORTE))

    nothing = F.lit(None)
    dues = F.transform(_dues(begin, end, config), lambda x: row(RECURRENT_KIND, x[CALENDAR_DATE], x[EXPECTED_AMOUNT], nothing, nothing, nothing))
    sums = F.transform(MONTHS, lambda x: row(LEVEL_KIND, nothing, nothing, x[YEAR], x[MONTH], x[SUM_IMPORTE]))
    rows = chosen.select(CUSTOMER, F.inline(F.when(F.col(STATUS).isin(*RECURRENT), dues).when(F.col(NON_RECURRENT), sums)))
    customer = [CUSTOMER, "kind"]
    added = rows.groupBy(*customer, CALENDAR_DATE, YEAR, MONTH).agg(F.sum(SUM_IMPORTE).alias(SUM_IMPORTE), *_day_sums())
    folded = monthly_percentile(added, customer).groupBy(*customer).agg(daily_level(config), *_folded())
    days = folded.select("*", F.explode(calendar_sequence(begin, end)).alias(CALENDAR_DATE))
    amount = F.when(F.col("kind") == RECURRENT_KIND, _amount_on(F.col(CALENDAR_DATE))).otherwise(F.col(MONTH_IM).cast("double"))
    return days.select(CUSTOMER, "kind", CALENDAR_DATE, amount.alias("amount"))


def nonrecurrent_calendar(level: DataFrame, begin: date, end: date) -> DataFrame:
    """Long calendar of the flat non-recurrent level."""
    return level.select(CUSTOMER, F.explode(calendar_sequence(begin, end)).alias(CALENDAR_DATE),
                        F.col(MONTH_IM))


def nonrecurrent_calendar_wide(level: DataFrame, begin: date, end: date) -> DataFrame:
    return level.select(CUSTOMER, *[F.col(MONTH_IM).alias(str(d)) for d in horizon_days(begin, end)])
