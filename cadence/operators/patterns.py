"""Pattern statistics (20 per pattern) and the variation of the last amounts.

Scale notes. All statistics come from day groups (``sequence.day_groups``): one
aggregate over the rows with mergeable measures and map-side combine, dealt once
by customer and commerce. A pattern then has at most one row per calendar day,
however many payments it has; merging the marked and unmarked group of a day,
the window that gives the gaps between payment days and the pattern mean, and
the final aggregates all run on that partitioning, without another shuffle. The
pattern row carries its month sums and last marked amounts along, so the days
are walked once.
Standard deviations are merged like Spark merges partial aggregates (within-day
second moments plus the spread of the day means), and the day gaps and days of
the month are integers whose sums of squares are exact. The last payments are a
``row_number() <= k`` filter, which Spark plans as a map-side partial top-k
(``WindowGroupLimit``) before the shuffle, so at most k rows per pair and map
task travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.config import DEFAULT_CONFIG, RecurrenceConfig
from cadence.functions.stats import as_float, relative_error, sample_sd_from_moments
from cadence.operators.sequence import DAY_AMOUNT, DAY_PAYMENTS, RAW_ROWS, SALT, dealt_by_pair
from cadence.sources.schema import (
    AMOUNT, COMMERCE, CUSTOMER, CV_AMOUNT, DATE, DEBIT_TYPE, MARKED, MAX_AMOUNT, MAX_DAY_MONTH, MAX_DIFF_DAYS,
    MAX_FECHA, MEAN_AMOUNT, MEAN_DAY_MONTH, MEAN_DIFF_DAYS, MIN_AMOUNT, MIN_DAY_MONTH,
    MIN_DIFF_DAYS, MONTH, NU_PAYMENTS, NUM_PAGOS, ORDER_DESC, PAIR_KEYS, PATTERN_KEYS,
    RANGE_AMOUNT, RANGE_DAY_MONTH, RANGE_DIFF_DAYS, SD_AMOUNT, SD_DAY_MONTH, SD_DIFF_DAYS,
    SCOPE, SCOPE_COMMERCE, SRE_AMOUNT, SRE_DAY_MONTH, SRE_DIFF_DAYS, SUM_IMPORTE, YEAR,
)

HAS_MARKED = "has_marked"
MARKED_AMOUNT = "marked_amount"
MONTHS = "months"
LAST_MARKED = "last_marked"
LAST_UNMARKED = "last_unmarked"
MARKED_DAYS = "marked_days"
MEAN_RECENT = "mean_recent_amount"
SD_RECENT = "sd_recent_amount"

STAT_COLUMNS = [
    MEAN_AMOUNT, MEAN_DAY_MONTH, MEAN_DIFF_DAYS, NUM_PAGOS, SD_AMOUNT, SD_DAY_MONTH,
    SD_DIFF_DAYS, MAX_AMOUNT, MIN_AMOUNT, MAX_DAY_MONTH, MIN_DAY_MONTH, MAX_DIFF_DAYS,
    MIN_DIFF_DAYS, MAX_FECHA, RANGE_AMOUNT, RANGE_DAY_MONTH, RANGE_DIFF_DAYS, SRE_AMOUNT,
    SRE_DAY_MONTH, SRE_DIFF_DAYS,
]


def pattern_days(groups: DataFrame, keys: list[str] = PATTERN_KEYS) -> DataFrame:
    """One row per pattern and day from the day groups: payments, amount sum and
    the moments of the amount; ``marked_amount`` is the marked day-sum in it, with
    ``has_marked``. A pattern has two groups a day at most, a marked one and an
    unmarked one, whose second moments merge pairwise."""
    marked = F.col(MARKED)

    def of(which, column):
        return F.sum(F.when(which, F.col(column)))

    merged = groups.groupBy(*keys, DATE).agg(
        F.sum(DAY_PAYMENTS).alias(DAY_PAYMENTS),
        F.sum(RAW_ROWS).alias(RAW_ROWS),
        F.sum(DAY_AMOUNT).alias(DAY_AMOUNT),
        F.sum("_f_sum").alias("_f_sum"),
        F.sum("_f_n").alias("_f_n"),
        F.sum("_f_m2").alias("_f_m2"),
        F.max("_f_max").alias("_f_max"),
        F.min("_f_min").alias("_f_min"),
        F.max(MARKED).alias(HAS_MARKED),
        F.max(F.when(marked, F.col(DAY_AMOUNT))).alias(MARKED_AMOUNT),
        of(marked, "_f_n").alias("_na"), of(marked, "_f_sum").alias("_sa"),
        of(~marked, "_f_n").alias("_nb"), of(~marked, "_f_sum").alias("_sb"),
    )
    apart = F.try_divide(F.col("_sa"), F.col("_na")) - F.try_divide(F.col("_sb"), F.col("_nb"))
    between = F.coalesce(F.col("_na") * F.col("_nb") / (F.col("_na") + F.col("_nb")) * apart * apart, F.lit(0.0))
    return merged.withColumn("_f_m2", F.col("_f_m2") + between).drop("_na", "_sa", "_nb", "_sb")


def _pattern_rows(days: DataFrame, keys: list[str], recent: int) -> DataFrame:
    """One row per pattern with its mergeable measures, its month sums and its
    last ``recent`` marked day-sums. All windows run on one sort of a pattern's
    days (month, then day) where the days are dealt by customer and commerce; the
    row of the first day is kept and carries the totals."""
    everything = (Window.unboundedPreceding, Window.unboundedFollowing)
    by_day = Window.partitionBy(*keys).orderBy("_month", DATE)
    in_month = Window.partitionBy(*keys, "_month").orderBy(DATE)
    pattern = by_day.rowsBetween(*everything)
    is_marked = F.col(HAS_MARKED).cast("int")
    walked = days.select("*", (F.year(DATE) * 12 + F.month(DATE)).alias("_month")).select(
        "*", F.datediff(F.col(DATE), F.lag(DATE).over(by_day)).cast("long").alias("_gap"),
        F.row_number().over(by_day).alias("_place"),
        F.sum(is_marked).over(pattern).alias("_marks"),
        F.sum(is_marked).over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_marks_before"),
        F.sum("_f_sum").over(pattern).alias("_p_sum"), F.sum("_f_n").over(pattern).alias("_p_n"))
    by_month = walked.select("*", F.row_number().over(in_month).alias("_place_in_month"),
                             F.sum(DAY_AMOUNT).over(in_month.rowsBetween(*everything)).alias("_month_sum"))
    n_days, dom = F.col(DAY_PAYMENTS), F.dayofmonth(DATE).cast("long")
    apart = F.col("_f_sum") / F.col("_f_n") - F.col("_p_sum") / F.col("_p_n")
    month = F.when(F.col("_place_in_month") == 1, F.struct(F.year(DATE).alias(YEAR), F.month(DATE).alias(MONTH),
                                                           F.col("_month_sum").alias(SUM_IMPORTE)))
    last = F.when(F.col(HAS_MARKED) & (F.col("_marks") - F.col("_marks_before") < recent),
                  F.struct(F.col(DATE), F.col(MARKED_AMOUNT).alias(AMOUNT)))
    totals = {
        NU_PAYMENTS: F.sum(DAY_PAYMENTS), "_days": F.count(F.lit(1)), "_f_sum": F.max("_p_sum"), "_f_n": F.max("_p_n"),
        # each day's share of the amount's second moment around the pattern mean
        "_f_m2": F.sum(F.col("_f_m2") + F.col("_f_n") * apart * apart),
        "_f_max": F.max("_f_max"), "_f_min": F.min("_f_min"),
        "_s1": F.sum("_gap"), "_s2": F.sum(F.col("_gap") * F.col("_gap")), "_max_gap": F.max("_gap"), "_min_gap": F.min("_gap"),
        "_dom1": F.sum(n_days * dom), "_dom2": F.sum(n_days * dom * dom), MAX_DAY_MONTH: F.max(dom), MIN_DAY_MONTH: F.min(dom),
        MAX_FECHA: F.max(DATE), MONTHS: F.collect_list(month), LAST_MARKED: F.collect_list(last),
        RAW_ROWS: F.sum(RAW_ROWS), MARKED_DAYS: F.max("_marks"),
    }
    rows = by_month.select(*keys, "_place", *[total.over(pattern).alias(name) for name, total in totals.items()])
    # The gaps of a pattern of one day sum to 0.
    return rows.where(F.col("_place") == 1).drop("_place").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("_s1", "_s2")})


def pattern_statistics(days: DataFrame, keys: list[str] = PATTERN_KEYS, config: RecurrenceConfig = DEFAULT_CONFIG,
                       extras: bool = False) -> DataFrame:
    """The 20 statistics of every pattern and ``nu_payments``.

    With payments ordered by date, the gaps are the differences between
    consecutive payment days plus a 0 for every further payment on the same
    day; the first payment has no gap: ``m = n - 1`` gaps with sum
    ``last - first``.

    With ``extras`` also ``months``, the sum of each calendar month, and
    ``last_marked``, the last marked day-sums: what later steps need of the days,
    bounded by the months of the history; and two counts, ``raw_rows`` and
    ``marked_days``.
    """
    agg = _pattern_rows(days, keys, config.recent_payments)
    more = [MONTHS, LAST_MARKED, RAW_ROWS, MARKED_DAYS] if extras else []
    n = F.col(NU_PAYMENTS)
    m = n - 1
    same_day_repeats = n > F.col("_days")
    mean_amount = as_float(F.try_divide(F.col("_f_sum"), F.col("_f_n").cast("double")))
    sd_amount = as_float(F.sqrt(F.try_divide(F.col("_f_m2"), (F.col("_f_n") - 1).cast("double"))))
    mean_dom = as_float(F.try_divide(F.col("_dom1").cast("double"), n.cast("double")))
    sd_dom = as_float(sample_sd_from_moments(n, F.col("_dom1"), F.col("_dom2")))
    mean_gap = as_float(F.try_divide(F.col("_s1").cast("double"), m.cast("double")))
    sd_gap = as_float(sample_sd_from_moments(m, F.col("_s1"), F.col("_s2")))
    max_gap = F.when(same_day_repeats, F.coalesce(F.col("_max_gap"), F.lit(0))).otherwise(F.col("_max_gap"))
    min_gap = F.when(same_day_repeats, F.lit(0)).otherwise(F.col("_min_gap"))
    stats = agg.select(
        *keys, n,
        mean_amount.alias(MEAN_AMOUNT),
        mean_dom.alias(MEAN_DAY_MONTH),
        mean_gap.alias(MEAN_DIFF_DAYS),
        as_float(n).alias(NUM_PAGOS),
        sd_amount.alias(SD_AMOUNT),
        sd_dom.alias(SD_DAY_MONTH),
        sd_gap.alias(SD_DIFF_DAYS),
        as_float(F.col("_f_max")).alias(MAX_AMOUNT),
        as_float(F.col("_f_min")).alias(MIN_AMOUNT),
        F.col(MAX_DAY_MONTH).cast("int").alias(MAX_DAY_MONTH),
        F.col(MIN_DAY_MONTH).cast("int").alias(MIN_DAY_MONTH),
        max_gap.cast("int").alias(MAX_DIFF_DAYS),
        min_gap.cast("int").alias(MIN_DIFF_DAYS),
        F.col(MAX_FECHA), *more,
    )
    n_float = F.col(NUM_PAGOS)
    return stats.select(
        *keys, NU_PAYMENTS,
        MEAN_AMOUNT, MEAN_DAY_MONTH, MEAN_DIFF_DAYS, NUM_PAGOS, SD_AMOUNT, SD_DAY_MONTH,
        SD_DIFF_DAYS, MAX_AMOUNT, MIN_AMOUNT, MAX_DAY_MONTH, MIN_DAY_MONTH, MAX_DIFF_DAYS,
        MIN_DIFF_DAYS, MAX_FECHA,
        as_float(F.col(MAX_AMOUNT) - F.col(MIN_AMOUNT)).alias(RANGE_AMOUNT),
        (F.col(MAX_DAY_MONTH) - F.col(MIN_DAY_MONTH)).alias(RANGE_DAY_MONTH),
        (F.col(MAX_DIFF_DAYS) - F.col(MIN_DIFF_DAYS)).alias(RANGE_DIFF_DAYS),
        relative_error(F.col(SD_AMOUNT), n_float, F.col(MEAN_AMOUNT)).alias(SRE_AMOUNT),
        relative_error(F.col(SD_DAY_MONTH), n_float, F.col(MEAN_DAY_MONTH)).alias(SRE_DAY_MONTH),
        relative_error(F.col(SD_DIFF_DAYS), as_float(n_float - F.lit(1)),
                       F.col(MEAN_DIFF_DAYS)).alias(SRE_DIFF_DAYS),
        *more,
    )


def recent_unmarked(net: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """``last_unmarked``: the last unmarked payments of every customer and
    commerce, by a map-side partial top-k (``WindowGroupLimit``)."""
    latest = [F.col(DATE).desc(), F.col(AMOUNT).desc_nulls_last()]
    unmarked = F.coalesce(F.col(DEBIT_TYPE) != config.marked_debit_type, F.lit(False))
    by_time = Window.partitionBy(*PAIR_KEYS).orderBy(F.col("_unmarked").desc(), *latest)
    if config.partitions:
        # The last of every salt where the rows are dealt for the day groups, then of the pair.
        in_salt = Window.partitionBy(*PAIR_KEYS, SALT).orderBy(F.col("_unmarked").desc(), *latest)
        last = (dealt_by_pair(net, config.partitions).select(CUSTOMER, COMMERCE, DATE, AMOUNT, SALT, unmarked.alias("_unmarked"))
                .select("*", F.row_number().over(in_salt).alias(ORDER_DESC))
                .where(F.col(ORDER_DESC) <= config.recent_payments).where("_unmarked")
                .drop(ORDER_DESC).repartition(config.partitions, CUSTOMER, COMMERCE))
        by_pair = Window.partitionBy(*PAIR_KEYS).orderBy(*latest)
        return (last.select(CUSTOMER, COMMERCE, DATE, AMOUNT, F.row_number().over(by_pair).alias(ORDER_DESC))
                .where(F.col(ORDER_DESC) <= config.recent_payments)
                .groupBy(CUSTOMER, COMMERCE).agg(F.collect_list(F.struct(DATE, AMOUNT)).alias(LAST_UNMARKED)))
    # Sorted first instead of filtered: the rows are read with the same filters
    # as for the day groups, so that Spark can share the shuffle of the rows.
    return (net.select(CUSTOMER, COMMERCE, DATE, AMOUNT, unmarked.alias("_unmarked"))
            .select("*", F.row_number().over(by_time).alias(ORDER_DESC))
            .where(F.col(ORDER_DESC) <= config.recent_payments).where("_unmarked")
            .groupBy(CUSTOMER, COMMERCE).agg(F.collect_list(F.struct(DATE, AMOUNT)).alias(LAST_UNMARKED)))


def amount_variation(amounts: Column) -> list[Column]:
    """Mean, SD and coefficient of variation of an array of amounts; NULLs among
    them are left out, an SD needs two."""
    values = F.transform(F.filter(amounts, lambda x: x.isNotNull()), lambda x: as_float(x).cast("double"))
    n = F.size(values).cast("double")
    mean = F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), n)
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    mean_float = as_float(mean)
    sd = as_float(F.when(n > 1, F.sqrt(squares / (n - 1))))
    return [mean_float.alias(MEAN_RECENT), sd.alias(SD_RECENT), as_float(F.try_divide(sd, mean_float)).alias(CV_AMOUNT)]


def with_recent_variation(stats: DataFrame, unmarked: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Adds to the commerce patterns mean, SD and coefficient of variation of the
    last ``recent_payments`` amounts, latest first, of their marked day-sums and
    unmarked payments together."""
    u = unmarked.select(F.col(CUSTOMER).alias("_v_customer"), F.col(COMMERCE).alias("_v_commerce"), LAST_UNMARKED)
    # Null-safe on the commerce: a plain equality would let Spark infer a
    # NOT NULL filter and push it into this branch's scan, and the shuffles
    # the branch shares with the pattern statistics could no longer be reused.
    on = ((F.col(SCOPE) == SCOPE_COMMERCE) & (F.col(CUSTOMER) == F.col("_v_customer"))
          & F.col(COMMERCE).eqNullSafe(F.col("_v_commerce")))
    if config.partitions:
        # The pair as one struct, null-safe as well, by which both sides can be dealt.
        stats = stats.withColumn("_pair", F.struct(CUSTOMER, COMMERCE)).repartition(config.partitions, "_pair")
        u = (u.select(F.struct(F.col("_v_customer").alias(CUSTOMER), F.col("_v_commerce").alias(COMMERCE)).alias("_v_pair"), LAST_UNMARKED)
             .repartition(config.partitions, "_v_pair").hint("merge"))
        on = (F.col(SCOPE) == SCOPE_COMMERCE) & (F.col("_pair") == F.col("_v_pair"))
    both = F.concat(F.col(LAST_MARKED), F.coalesce(F.col(LAST_UNMARKED), F.filter(F.col(LAST_MARKED), lambda x: F.lit(False))))
    latest = F.slice(F.sort_array(both, asc=False), 1, config.recent_payments)
    others = [c for c in stats.columns if c not in (LAST_MARKED, "_pair")]
    found = stats.join(u, on, "left").select(*others, F.when(F.col(SCOPE) == SCOPE_COMMERCE, latest).alias("_latest"))
    return found.select(*others, *amount_variation(F.transform("_latest", lambda x: x[AMOUNT])))
