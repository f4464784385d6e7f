"""Non-recurrent spend: monthly sums, the percentile rule and the daily level.

Scale notes. Every pattern carries its month sums, so the months of all
payments that are not recurrent are rows of the pattern table: no payment or day
is read again. The percentile window runs over one customer's
months: bounded by the length of the history, not by the number of payments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.config import DEFAULT_CONFIG, RecurrenceConfig
from cadence.operators.classify import NON_RECURRENT
from cadence.operators.patterns import MONTHS
from cadence.sources.schema import CUSTOMER, MONTH, MONTH_IM, NUM_ROWS, PERCENTILE, PERCENTILE_IM, SUM_IMPORTE, YEAR


def nonrecurrent_monthly(patterns: DataFrame) -> DataFrame:
    """Sum per customer, year and month of all payments that are not recurrent,
    from the month sums that each pattern carries."""
    months = patterns.where(F.col(NON_RECURRENT)).select(CUSTOMER, F.inline(MONTHS))
    return months.groupBy(CUSTOMER, YEAR, MONTH).agg(F.sum(SUM_IMPORTE).alias(SUM_IMPORTE))


def monthly_percentile(monthly: DataFrame, keys: list[str] = (CUSTOMER,)) -> DataFrame:
    """Percent rank of each month's sum within its customer; the sum is kept
    when the rank is at least ``1 - 1/n``. With ``(rank-1)/(n-1)`` only the
    largest month passes, and only if no other month ties with it."""
    by_sum = Window.partitionBy(*keys).orderBy(SUM_IMPORTE)
    all_months = Window.partitionBy(*keys)
    ranked = monthly.select("*", F.percent_rank().over(by_sum).alias(PERCENTILE),
                            F.count(F.lit(1)).over(all_months).alias(NUM_ROWS))
    threshold = F.lit(1.0) - F.lit(1.0) / F.col(NUM_ROWS)
    return ranked.select("*", F.when(F.col(PERCENTILE) >= threshold, F.col(SUM_IMPORTE)).alias(PERCENTILE_IM))


def daily_level(config: RecurrenceConfig = DEFAULT_CONFIG) -> Column:
    """The kept month sum divided by ``level_days``, as an aggregate."""
    return (F.min(PERCENTILE_IM) / F.lit(config.level_days)).alias(MONTH_IM)


def nonrecurrent_level(percentiles: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Daily non-recurrent level of each customer."""
    return percentiles.groupBy(CUSTOMER).agg(daily_level(config))
