"""Fate of every pattern: similar amount, alive, regularity class.

All decisions are column expressions over the pattern table (one row per
pattern); rows of the payments are never joined back to take them. The
``status`` column names the branch a pattern ends in:

* ``SINGLE``: commerce pattern with at most two payments (non-recurrent);
* ``DISSIMILAR``: commerce pattern whose last amounts vary too much (non-recurrent);
* ``DROPPED``: commerce pattern without a commerce key; equality on a NULL key
  matches nothing, so such a pattern is in no output;
* ``LAPSED``: no payment since the horizon (non-recurrent);
* ``HARD`` / ``SOFT``: regular recurrences, relative error of the day gaps below
  / above the limit;
* ``IRREGULAR``: day gaps spread wider than their mean (non-recurrent);
* ``UNCLASSIFIED``: range equal to the mean, or an undefined or exactly
  boundary relative error; such patterns are in no output.

Lapsed or irregular patterns whose key holds a NULL are not moved to the
non-recurrent rows either (``non_recurrent`` is false): the original model moved
them with an equi-join on the pattern key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.config import DEFAULT_CONFIG, RecurrenceConfig
from cadence.functions.dates import horizon
from cadence.operators.prepare import joined_by_key
from cadence.operators.sequence import null_safe_on
from cadence.sources.schema import (
    AMOUNT, COMMERCE, CUSTOMER, CV_AMOUNT, CV_FILTER, DATE, DELTA_AVG, DELTA_STD, HORIZON, IMP_OPER,
    MAX_FEC_TRANS, MAX_FECHA, MEAN_AMOUNT, MEAN_DIFF_DAYS, NU_PAYMENTS, PATTERN_AMOUNT,
    PATTERN_KEYS, RANGE_DIFF_DAYS, SCOPE, SCOPE_COMMERCE, SD_DIFF_DAYS, SRE_DIFF_DAYS, STATUS,
)

SINGLE = "SINGLE"
DISSIMILAR = "DISSIMILAR"
DROPPED = "DROPPED"
LAPSED = "LAPSED"
HARD = "HARD"
SOFT = "SOFT"
IRREGULAR = "IRREGULAR"
UNCLASSIFIED = "UNCLASSIFIED"

RECURRENT = [HARD, SOFT]
NON_RECURRENT = "non_recurrent"
LIVE = "live"
REGULARITY = "regularity"


def similar_amount(config: RecurrenceConfig) -> Column:
    """CV below the limit; an undefined CV (mean 0) is not similar."""
    return F.coalesce(F.col(CV_AMOUNT) < config.cv_limit, F.lit(False))


def regularity(config: RecurrenceConfig) -> Column:
    regular = F.col(RANGE_DIFF_DAYS) < F.col(MEAN_DIFF_DAYS)
    return (F.when(regular & (F.col(SRE_DIFF_DAYS) < config.sre_limit), F.lit(HARD))
             .when(regular & (F.col(SRE_DIFF_DAYS) > config.sre_limit), F.lit(SOFT))
             .when(F.col(RANGE_DIFF_DAYS) > F.col(MEAN_DIFF_DAYS), F.lit(IRREGULAR))
             .otherwise(F.lit(UNCLASSIFIED)))


def categorize(p: DataFrame, as_of: Column, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Pattern table (statistics with the variation of the last amounts) with CV
    flag, horizon, liveness, regularity and status."""
    commerce_pattern = F.col(SCOPE) == SCOPE_COMMERCE
    until = horizon(F.col(MAX_FECHA), F.col(SD_DIFF_DAYS), F.col(MEAN_DIFF_DAYS), config.sd_factor)
    status = (
        F.when(F.col(NU_PAYMENTS) < config.min_payments, F.lit(SINGLE))
         .when(commerce_pattern & F.col(COMMERCE).isNull(), F.lit(DROPPED))
         .when(commerce_pattern & ~similar_amount(config), F.lit(DISSIMILAR))
         .when(as_of > F.col(HORIZON), F.lit(LAPSED))
         .otherwise(F.col(REGULARITY))
    )
    key_complete = (F.col(CUSTOMER).isNotNull() & F.col(COMMERCE).isNotNull()
                    & (commerce_pattern | F.col(PATTERN_AMOUNT).isNotNull()))
    return (
        p.withColumn(CV_FILTER, F.when(commerce_pattern, similar_amount(config).cast("int")))
         .withColumn(HORIZON, until)
         .withColumn(LIVE, as_of <= F.col(HORIZON))
         .withColumn(REGULARITY, regularity(config))
         .withColumn(STATUS, status)
         .withColumn(NON_RECURRENT,
                     F.col(STATUS).isin(SINGLE, DISSIMILAR)
                     | (F.col(STATUS).isin(LAPSED, IRREGULAR) & key_complete))
    )


def live_recurrences(patterns: DataFrame) -> DataFrame:
    """Candidate patterns (amount, or commerce with similar amounts) that are
    still alive at the reference date."""
    return patterns.where(F.col(STATUS).isin(HARD, SOFT, IRREGULAR, UNCLASSIFIED))


def lapsed_recurrences(patterns: DataFrame) -> DataFrame:
    return patterns.where(F.col(STATUS) == LAPSED)


def unified_recurrences(patterns: DataFrame) -> DataFrame:
    """Hard and soft recurrences of both scopes in the five-column shape used
    by the forecast."""
    return patterns.where(F.col(STATUS).isin(*RECURRENT)).select(
        F.col(CUSTOMER),
        F.col(MEAN_AMOUNT).alias(IMP_OPER),
        F.col(MAX_FECHA).alias(MAX_FEC_TRANS),
        F.col(MEAN_DIFF_DAYS).alias(DELTA_AVG),
        F.col(SD_DIFF_DAYS).alias(DELTA_STD),
    )


def pattern_transactions(payments: DataFrame, patterns: DataFrame, statuses: list[str],
                         partitions: int | None = None) -> DataFrame:
    """Payments (or blocks of them) of the patterns with one of ``statuses``, with the status.

    An equi-join on the pattern key: AQE splits a skewed pattern into several
    tasks; the pattern side is one row per pattern. With ``partitions`` the pattern key
    is dealt as in ``joined_by_key``."""
    if partitions:
        chosen = patterns.where(F.col(STATUS).isin(*statuses)).select(*PATTERN_KEYS, STATUS)
        return joined_by_key(payments, chosen, PATTERN_KEYS, [DATE, AMOUNT], partitions)
    chosen = patterns.where(F.col(STATUS).isin(*statuses)).select(
        *[F.col(k).alias("_p_" + k) for k in PATTERN_KEYS], F.col(STATUS))
    return payments.join(chosen, null_safe_on(PATTERN_KEYS, "_p_"), "inner").drop(
        *["_p_" + k for k in PATTERN_KEYS])

