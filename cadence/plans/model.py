"""``fit`` and ``predict``: the recurrence model as a chain of DataFrame transforms.

``fit`` starts no Spark job: it returns immutable DataFrames (the stages of
the model) whose plans Catalyst and AQE optimise when the caller acts on them.
``model.forecast()`` returns both calendars in one DataFrame for one action.

With ``checkpoint=True`` two tables are written as parquet into one folder
below the shared checkpoint folder of the cluster (``spark.checkpoint.dir``):
the pattern rows, which carry their month sums, and the monthly non-recurrent
table. Later stages read them instead of computing
them again, and a lost executor costs no recompute of the raw shuffles. The
folder is ``RecurrenceModel.checkpoint_folder``; removing it is the caller's.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cadence.config import DEFAULT_CONFIG, RecurrenceConfig
from cadence.operators import calendar, classify, level, patterns, prepare, sequence
from cadence.sources.schema import AMOUNT, COMMERCE, CUSTOMER, DATE, NU_PAYMENTS, SCOPE, SCOPE_AMOUNT, SCOPE_COMMERCE
from cadence.sources.transactions import conform


class Probes:
    """Counters that the stages of one fit fill while an action runs."""

    def __init__(self):
        self._customers, self._patterns = Observation(), Observation()

    def customers(self, recent: DataFrame) -> DataFrame:
        total = F.coalesce(F.sum("rows"), F.lit(0))
        return recent.observe(self._customers, F.count(F.lit(1)).alias("active_customers"),
                              total.alias("filtered_transactions")).select(CUSTOMER)

    def patterns(self, stats: DataFrame, config: RecurrenceConfig) -> DataFrame:
        commerce, n, marked = F.col(SCOPE) == SCOPE_COMMERCE, F.col(NU_PAYMENTS), F.coalesce(patterns.MARKED_DAYS, F.lit(0))
        repeated = n >= config.min_payments

        def total(value: Column, which: Column | None = None) -> Column:
            return F.coalesce(F.sum(value if which is None else F.when(which, value)), F.lit(0))

        counted = {
            "after_reversals": total(F.col(sequence.RAW_ROWS)),
            "recurrents": total(marked), "no_recurrents": total(n - marked), "evaluated_amount": total(marked),
            "amount_recurrents": total(n, F.col(SCOPE) == SCOPE_AMOUNT), "amount_no_recurrents": total(marked, commerce),
            "evaluated_commerce": total(n, commerce), "commerce_recurrents": total(n, commerce & repeated),
            "commerce_no_recurrents": total(n, commerce & ~repeated),
        }
        seen = stats.observe(self._patterns, *[value.alias(name) for name, value in counted.items()])
        return seen.where(F.col(SCOPE) != sequence.NO_SCOPE)

    def counts(self) -> dict[str, int]:
        return {name: int(value) for probe in (self._customers, self._patterns) for name, value in probe.get.items()}


@dataclass(frozen=True)
class RecurrenceModel:
    config: RecurrenceConfig
    as_of: Column
    transactions: DataFrame   # conformed input
    all_net: DataFrame        # rows of all customers without reversed operations
    days: DataFrame           # one row per pattern and day
    pattern_rows: DataFrame   # one row per pattern of an active customer: statistics, status, months
    monthly: DataFrame        # non-recurrent sum per customer and month
    level: DataFrame          # non-recurrent daily level per customer
    checkpoint_folder: str | None = None    # what ``checkpoint=True`` wrote; the caller removes it
    probes: Probes | None = None            # with ``observe=True``

    def counts(self) -> dict[str, int]:
        """The eleven row counts along the stages, after an action that reads the
        pattern rows; it waits for one."""
        if self.probes is None:
            raise RuntimeError("counts() needs fit(..., observe=True)")
        return self.probes.counts()

    @property
    def patterns(self) -> DataFrame:
        """One row per pattern of an active customer: statistics and status."""
        return self.pattern_rows.drop(patterns.MONTHS)

    @property
    def net(self) -> DataFrame:
        """Rows of active customers without reversed operations."""
        return prepare.prepared(self.transactions, self.as_of, self.config)

    def active_blocks(self) -> DataFrame:
        """Payments of active customers with their pattern key, as counted
        blocks: one pass over the raw rows; the activity filter meets blocks."""
        blocks = sequence.payment_blocks(self.all_net, self.config)
        recent = prepare.recent_customers(self.transactions, self.as_of, self.config)
        if self.config.partitions:
            return prepare.joined_by_key(blocks, recent, [CUSTOMER], [COMMERCE, DATE, AMOUNT], self.config.partitions)
        return blocks.join(recent, CUSTOMER, "left_semi")

    def active_payments(self) -> DataFrame:
        """Payments of active customers with their pattern key (row level)."""
        return sequence.payments_of(self.active_blocks(), self.config.partitions)

    @property
    def recurrences(self) -> DataFrame:
        return classify.unified_recurrences(self.patterns)

    def predict(self, begin: date | None = None, end: date | None = None):
        """Recurrent and non-recurrent calendars, one column per date."""
        begin, end = self._horizon(begin, end)
        return (calendar.recurrent_calendar_wide(self.recurrences, begin, end, self.config),
                calendar.nonrecurrent_calendar_wide(self.level, begin, end))

    def predict_long(self, begin: date | None = None, end: date | None = None):
        """Recurrent and non-recurrent calendars as (customer, date, amount) rows."""
        begin, end = self._horizon(begin, end)
        return (calendar.recurrent_calendar(self.recurrences, begin, end, self.config),
                calendar.nonrecurrent_calendar(self.level, begin, end))

    def forecast(self, begin: date | None = None, end: date | None = None) -> DataFrame:
        """Both long calendars in one DataFrame, ``kind`` = recurrent or
        nonrecurrent, from one walk over the pattern table: the plan has no
        branches that would each evaluate the fitted stages."""
        begin, end = self._horizon(begin, end)
        return calendar.both_calendars(self.pattern_rows, begin, end, self.config)

    def _horizon(self, begin, end):
        return (begin or self.config.default_begin, end or self.config.default_end)


def _checkpoint_folder(spark) -> str:
    """A new folder, one for each fit, in the shared checkpoint folder of the
    cluster (``spark.checkpoint.dir``). The caller removes it when the model is
    no longer used (``RecurrenceModel.checkpoint_folder``)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("checkpoint=True needs spark.checkpoint.dir (a shared folder)")
    return f"{folder.rstrip('/')}/cadence-{uuid.uuid4().hex}"


def _checkpointed(df: DataFrame, folder: str | None, name: str) -> DataFrame:
    """``df`` written as parquet and read back, where a folder is given: the
    lineage is cut, and later stages read only the columns they need."""
    if folder is None:
        return df
    df.write.mode("errorifexists").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def fit(transactions: DataFrame, as_of=None, config: RecurrenceConfig = DEFAULT_CONFIG,
        checkpoint: bool = False, observe: bool = False) -> RecurrenceModel:
    """Fit the recurrence model on a transaction table.

    With ``observe`` the first action on the model (or the write of ``checkpoint``)
    counts the rows along the stages as they pass, without a job or a scan of its
    own: ``model.counts()``.

    ``as_of`` is the reference date (a ``date``, ISO string or date column);
    by default the last operation date of the table.
    """
    tx = conform(transactions)
    reference = prepare.reference_date(tx, as_of)
    if config.cut_after_reference:
        tx = tx.where(F.col(DATE) <= reference)
    # Reversals go first, on all customers: the activity filter is applied to
    # the pattern table below, so the payment rows are shuffled once (for the
    # reversal anti-join) instead of once more by customer. Every later step
    # groups by keys that contain the customer, so the result is the same.
    net = prepare.net_of_reversals(tx, config)
    folder = _checkpoint_folder(transactions.sparkSession) if checkpoint else None
    # One aggregate over the rows to at most one row per pattern and day, and one
    # walk over these days to the pattern rows; everything else reads those.
    days = patterns.pattern_days(sequence.day_groups(net, config))
    probes = Probes() if observe else None
    if probes:
        recent = probes.customers(prepare.recent_customers_counted(tx, reference, config))
        every = patterns.pattern_days(sequence.day_groups(net, config, untyped=True))
        stats = probes.patterns(patterns.pattern_statistics(every, config=config, extras=True).join(recent, CUSTOMER, "left_semi"), config)
    else:
        recent = prepare.recent_customers(tx, reference, config)
        every = patterns.pattern_statistics(days, config=config, extras=True)
        if config.partitions:
            # No broadcast, and no semi join that Spark would move to the rows (``prepare.joined_by_key``).
            recent = recent.repartition(config.partitions, CUSTOMER).hint("merge")
            stats = every.repartition(config.partitions, CUSTOMER).join(recent, CUSTOMER).select(*every.columns)
        else:
            stats = every.join(recent, CUSTOMER, "left_semi")
    stats = stats.drop(sequence.RAW_ROWS, patterns.MARKED_DAYS)
    stats = patterns.with_recent_variation(stats, patterns.recent_unmarked(net, config), config)
    if config.partitions:
        # Months, levels and calendars all group by customer.
        stats = stats.repartition(config.partitions, CUSTOMER)
    rows = _checkpointed(classify.categorize(stats, reference, config), folder, "patterns")
    monthly = _checkpointed(level.nonrecurrent_monthly(rows), folder, "monthly")
    level_table = level.nonrecurrent_level(level.monthly_percentile(monthly), config)
    return RecurrenceModel(config, reference, tx, net, days, rows, monthly, level_table, folder, probes)


def predict(model: RecurrenceModel, begin: date | None = None, end: date | None = None):
    return model.predict(begin, end)
