"""Registered queries: one per operator of the model, over the driver's tables.

Each query derives a transaction table from the test tables with Spark
(``sources.testdata``), fits the model lazily and returns one stage. Output
columns are cast to engine-neutral types (BIGINT counts, DOUBLE rounded to 6
places for the model's 32-bit statistics, DECIMAL(38,s) amounts) so that the
same values come out of Spark and of the DuckDB oracle in ``oracle/``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.config import DEFAULT_CONFIG
from cadence.functions.dates import horizon_days
from cadence.operators import calendar, classify, level, patterns, prepare, sequence
from cadence.operators.classify import NON_RECURRENT, REGULARITY
from cadence.plans.model import RecurrenceModel, fit
from cadence.sources import testdata
from cadence.sources.transactions import conform
from cadence.sources.schema import (
    CALENDAR_DATE, COMMERCE, CUSTOMER, CV_AMOUNT, CV_FILTER, DATE, DAY_MONTH, DEBIT_TYPE, MARKED,
    DELTA_AVG, DELTA_STD, DIFFERENCE_OF_DAYS, EXPECTED_AMOUNT, HORIZON, IMP_OPER, MAX_FEC_TRANS,
    MAX_FECHA, MEAN_AMOUNT, MEAN_DIFF_DAYS, MONTH, MONTH_IM, NU_PAYMENTS, NUM_ROWS, ORDER,
    ORDER_DESC, PAIR_KEYS, PATTERN_AMOUNT, PERCENTILE, PERCENTILE_IM,
    PREVIOUS_AMOUNT, RANGE_DIFF_DAYS, SCOPE, SCOPE_AMOUNT, SCOPE_COMMERCE, SD_AMOUNT,
    SD_DIFF_DAYS, SRE_DIFF_DAYS, STATUS, SUM_IMPORTE, TRANSACTION_COLUMNS, WEIGHT, YEAR, AMOUNT,
)
from cadence.operators.patterns import STAT_COLUMNS

# Output kinds: how a column is presented in both engines.
KEEP, LONG, FLOAT, MONEY, RATIO = "keep", "long", "float", "money", "ratio"


def present(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    def cast(name, kind):
        c = F.col(name)
        if kind == LONG:
            c = c.cast("bigint")
        elif kind == FLOAT:
            c = F.round(c.cast("double"), 6)
        elif kind == MONEY:
            c = c.cast("decimal(38,2)")
        elif kind == RATIO:
            c = c.cast("decimal(38,6)")
        return c.alias(name)
    return df.select(*[cast(n, k) for n, k in columns])


TX_COLUMNS = [(c, MONEY if c in (AMOUNT, "original_transaction_amount") else KEEP)
              for c in TRANSACTION_COLUMNS]
PAYMENT4 = [(CUSTOMER, KEEP), (COMMERCE, KEEP), (AMOUNT, MONEY), (DATE, KEEP)]
SEQUENCE = PAYMENT4 + [(DIFFERENCE_OF_DAYS, LONG), (PREVIOUS_AMOUNT, MONEY), (DAY_MONTH, LONG),
                       (NU_PAYMENTS, LONG), (ORDER, LONG), (ORDER_DESC, LONG)]
PATTERN = [(CUSTOMER, KEEP), (COMMERCE, KEEP), (SCOPE, KEEP), (PATTERN_AMOUNT, MONEY)]
_INT_STATS = {"MAX_day_month", "MIN_day_month", "MAX_days_diff", "MIN_days_diff",
              "RANGE_days_month", "RANGE_days_diff"}
STATS = PATTERN + [(NU_PAYMENTS, LONG)] + [
    (c, KEEP if c == MAX_FECHA else LONG if c in _INT_STATS else FLOAT) for c in STAT_COLUMNS]
RECURRENCE = [(CUSTOMER, KEEP), (IMP_OPER, FLOAT), (MAX_FEC_TRANS, KEEP), (DELTA_AVG, FLOAT),
              (DELTA_STD, FLOAT)]
CANDIDATES = ["LAPSED", "HARD", "SOFT", "IRREGULAR", "UNCLASSIFIED"]


@dataclass(frozen=True)
class Source:
    """A transaction table derived from the test tables, with its test dates."""
    name: str
    load: Callable[[SparkSession, str], DataFrame]
    as_of: date | None
    begin: date
    end: date
    table: str          # its rows decide how many partitions the transactions get


F1 = Source("customer", testdata.customer_transactions, testdata.F1_AS_OF, testdata.F1_BEGIN, testdata.F1_END, "customer")
F2 = Source("lineitem", testdata.lineitem_transactions, None, date(2001, 11, 5), date(2001, 12, 5), "lineitem")
F3 = Source("events", testdata.event_transactions, None, date(2024, 1, 31), date(2024, 3, 1), "events")
F4 = Source("gaps", testdata.customer_transactions_with_gaps, testdata.F1_AS_OF, testdata.F1_BEGIN,
            testdata.F1_END, "customer")
F5 = Source("lineitem_returns", testdata.lineitem_transactions_with_returns, F2.as_of, F2.begin, F2.end, "lineitem")
F6 = Source("event_returns", testdata.event_transactions_with_returns, F3.as_of, F3.begin, F3.end, "events")


@dataclass(frozen=True)
class Context:
    spark: SparkSession
    source: Source
    raw: DataFrame      # the projected rows, before those without a date or customer go
    tx: DataFrame
    model: RecurrenceModel


def context(spark: SparkSession, sf_dir: str, source: Source = F1) -> Context:
    raw = source.load(spark, sf_dir)
    tx = conform(raw)
    config = replace(DEFAULT_CONFIG, partitions=testdata.partitions(spark, sf_dir, source.table))
    return Context(spark, source, raw, tx, fit(tx, source.as_of, config))


# --- one builder per operator; each returns an unpresented DataFrame ---

def _candidates(m: RecurrenceModel) -> DataFrame:
    return m.patterns.where(F.col(STATUS).isin(*CANDIDATES))


def q_active_customers(c: Context):
    return prepare.active_customers(c.tx, c.model.as_of, c.model.config)


def q_transaction_projection(c: Context):
    return c.raw


def q_net_of_reversals(c: Context):
    return c.model.net


def q_marked_recurring_daily(c: Context):
    return prepare.marked_recurring_daily(c.model.net)


def q_not_marked(c: Context):
    return prepare.not_marked(c.model.net)


def q_payment_blocks(c: Context):
    return sequence.payment_blocks(c.model.net)


def q_payment_sequence(c: Context):
    return sequence.payment_sequence(sequence.commerce_scope(c.model.active_blocks()), PAIR_KEYS, partitions=c.model.config.partitions)


def q_amount_recurrences(c: Context):
    return sequence.amount_recurrences(prepare.marked_recurring_daily(c.model.net))


def q_commerce_recurrences(c: Context):
    return sequence.commerce_recurrences(c.model.active_blocks(), c.model.config)


def q_pattern_statistics(c: Context):
    p = c.model.patterns
    return p.where((F.col(SCOPE) == SCOPE_AMOUNT) | F.col(STATUS).isin(*CANDIDATES))


def _commerce_candidates(m: RecurrenceModel) -> DataFrame:
    return m.patterns.where((F.col(SCOPE) == SCOPE_COMMERCE) & (F.col(NU_PAYMENTS) >= 3)
                            & F.col(COMMERCE).isNotNull())


def q_recent_amount_variation(c: Context):
    mean, sd = F.col(patterns.MEAN_RECENT).alias(MEAN_AMOUNT), F.col(patterns.SD_RECENT).alias(SD_AMOUNT)
    return _commerce_candidates(c.model).select(CUSTOMER, COMMERCE, mean, sd, CV_AMOUNT)


def q_similar_amount_recurrences(c: Context):
    flags = _commerce_candidates(c.model).select(*PAIR_KEYS, CV_FILTER)
    if parts := c.model.config.partitions:
        # The flags meet the counted blocks, which expand into payments afterwards.
        blocks = sequence.commerce_scope(c.model.active_blocks())
        return sequence.payments_of(prepare.joined_by_key(blocks, flags, PAIR_KEYS, [DATE, AMOUNT], parts), parts)
    return sequence.commerce_scope(c.model.active_payments()).join(flags, PAIR_KEYS, "inner")


def _pattern_transactions(m: RecurrenceModel, chosen: DataFrame, statuses: list[str]) -> DataFrame:
    if parts := m.config.partitions:
        # The patterns meet the counted blocks, which expand into payments afterwards.
        return sequence.payments_of(classify.pattern_transactions(m.active_blocks(), chosen, statuses, parts), parts)
    return classify.pattern_transactions(m.active_payments(), chosen, statuses)


def q_pattern_transactions(c: Context):
    return _pattern_transactions(c.model, c.model.patterns, CANDIDATES)


def q_recurrence_horizon(c: Context):
    return _candidates(c.model)


def q_live_recurrences(c: Context):
    return classify.live_recurrences(c.model.patterns)


def q_lapsed_recurrences(c: Context):
    return classify.lapsed_recurrences(c.model.patterns)


def q_lapsed_to_nonrecurrent(c: Context):
    moved = c.model.patterns.where((F.col(STATUS) == "LAPSED") & F.col(NON_RECURRENT))
    return _pattern_transactions(c.model, moved, ["LAPSED"])


def q_regularity_class(c: Context):
    return classify.live_recurrences(c.model.patterns)


def q_categorized_recurrences(c: Context):
    return c.model.patterns


def q_nonrecurrent_monthly(c: Context):
    return c.model.monthly


def q_monthly_percentile(c: Context):
    return level.monthly_percentile(c.model.monthly)


def q_nonrecurrent_level(c: Context):
    return c.model.level


def q_unified_recurrences(c: Context):
    return c.model.recurrences


def q_expected_payment(c: Context):
    return calendar.expected_payments(c.model.recurrences, c.source.begin, c.source.end)


def q_recurrent_calendar(c: Context):
    return calendar.recurrent_calendar(c.model.recurrences, c.source.begin, c.source.end)


def q_recurrent_calendar_wide(c: Context):
    return c.model.predict(c.source.begin, c.source.end)[0]


def q_nonrecurrent_calendar(c: Context):
    return calendar.nonrecurrent_calendar(c.model.level, c.source.begin, c.source.end)


def q_nonrecurrent_calendar_wide(c: Context):
    return c.model.predict(c.source.begin, c.source.end)[1]


def q_fit(c: Context):
    """Both fitted tables in one result: recurrences and non-recurrent levels."""
    m = c.model
    rec = m.recurrences.select(CUSTOMER, F.lit("recurrence").alias("kind"), IMP_OPER, MAX_FEC_TRANS,
                               DELTA_AVG, DELTA_STD)
    lvl = m.level.select(CUSTOMER, F.lit("level").alias("kind"), MONTH_IM)
    return rec.unionByName(lvl, allowMissingColumns=True)


def q_predict(c: Context):
    """Both calendars in one result (one Spark job shares the fitted stages)."""
    return c.model.forecast(c.source.begin, c.source.end)


def q_stage_counts(c: Context):
    """The row counts along the model (the original printed them with one
    job each) and of the rows that take no part: one query, the pattern-level
    counts summed from the pattern table."""
    m = c.model
    active = prepare.active_customers(c.tx, m.as_of, m.config)
    net = prepare.prepared(c.tx, m.as_of, m.config, reversals_first=bool(m.config.partitions))
    pays = m.active_blocks()
    marked, commerce = F.col(MARKED), F.col(SCOPE) == SCOPE_COMMERCE
    n = F.col(NU_PAYMENTS)

    def weighed(which):
        return F.coalesce(F.sum(F.when(which, F.col(WEIGHT))), F.lit(0))

    def stacked(df, pairs):
        args = ", ".join(f"'{name}', `{name}`" for name, _ in pairs)
        return df.agg(*[expr.alias(name) for name, expr in pairs]).select(
            F.expr(f"stack({len(pairs)}, {args})").alias("stage", "rows"))

    no_date = F.col(DATE).isNull()
    return (stacked(prepare.recent_customers(c.tx, m.as_of), [("active_customers", F.count(F.lit(1)))])
            .unionByName(stacked(c.raw, [("without_date", F.count_if(no_date)),
                                         ("without_customer", F.count_if(~no_date & F.col(CUSTOMER).isNull()))]))
            .unionByName(stacked(active, [("filtered_transactions", F.count(F.lit(1)))]))
            .unionByName(stacked(net, [("after_reversals", F.count(F.lit(1))),
                                         ("without_debit_type", F.count_if(F.col(DEBIT_TYPE).isNull()))]))
            .unionByName(stacked(pays, [
                ("recurrents", weighed(marked)),
                ("no_recurrents", weighed(~marked)),
                ("evaluated_amount", weighed(marked)),
                ("amount_no_recurrents", weighed(marked & commerce)),
                ("evaluated_commerce", weighed(commerce)),
            ]))
            .unionByName(stacked(m.patterns, [
                ("amount_recurrents", F.coalesce(F.sum(F.when(~commerce, n)), F.lit(0))),
                ("commerce_recurrents", F.coalesce(F.sum(F.when(commerce & (n >= 3), n)), F.lit(0))),
                ("commerce_no_recurrents", F.coalesce(F.sum(F.when(commerce & (n < 3), n)), F.lit(0))),
            ])))


def _wide(source: Source, kind: str) -> list[tuple[str, str]]:
    return [(CUSTOMER, KEEP)] + [(str(d), kind) for d in horizon_days(source.begin, source.end)]


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Context], DataFrame]
    columns: Callable[[Source], list[tuple[str, str]]]
    source: Source = F1


def _cols(cols):
    return lambda _source: cols


BLOCK_COLS = [(CUSTOMER, KEEP), (COMMERCE, KEEP), (DATE, KEEP), (MARKED, KEEP), (AMOUNT, MONEY),
              (WEIGHT, LONG), (SCOPE, KEEP), (PATTERN_AMOUNT, MONEY)]
HORIZON_COLS = PATTERN + [(MAX_FECHA, KEEP), (SD_DIFF_DAYS, FLOAT), (MEAN_DIFF_DAYS, FLOAT),
                          (HORIZON, KEEP)]
CLASS_COLS = PATTERN + [(RANGE_DIFF_DAYS, LONG), (MEAN_DIFF_DAYS, FLOAT), (SRE_DIFF_DAYS, FLOAT),
                        (REGULARITY, KEEP)]
CATEGORY_COLS = PATTERN + [(NU_PAYMENTS, LONG), (STATUS, KEEP)]
FIT_COLS = [(CUSTOMER, KEEP), ("kind", KEEP), (IMP_OPER, FLOAT), (MAX_FEC_TRANS, KEEP),
            (DELTA_AVG, FLOAT), (DELTA_STD, FLOAT), (MONTH_IM, RATIO)]
PREDICT_COLS = [(CUSTOMER, KEEP), ("kind", KEEP), (CALENDAR_DATE, KEEP), ("amount", FLOAT)]

QUERIES = [
    Query("active_customers", q_active_customers, _cols(TX_COLUMNS)),
    Query("transaction_projection", q_transaction_projection, _cols(TX_COLUMNS)),
    Query("net_of_reversals", q_net_of_reversals, _cols(TX_COLUMNS)),
    Query("marked_recurring_daily", q_marked_recurring_daily,
          _cols([(CUSTOMER, KEEP), (COMMERCE, KEEP), (DATE, KEEP), (AMOUNT, MONEY)])),
    Query("not_marked", q_not_marked, _cols(PAYMENT4)),
    Query("payment_blocks", q_payment_blocks, _cols(BLOCK_COLS)),
    Query("payment_sequence", q_payment_sequence, _cols(SEQUENCE)),
    Query("amount_recurrences", q_amount_recurrences, _cols(SEQUENCE)),
    Query("commerce_recurrences", q_commerce_recurrences, _cols(SEQUENCE)),
    Query("pattern_statistics", q_pattern_statistics, _cols(STATS)),
    Query("recent_amount_variation", q_recent_amount_variation,
          _cols([(CUSTOMER, KEEP), (COMMERCE, KEEP), (MEAN_AMOUNT, FLOAT), (SD_AMOUNT, FLOAT),
                 (CV_AMOUNT, FLOAT)])),
    Query("similar_amount_recurrences", q_similar_amount_recurrences, _cols(PAYMENT4 + [(CV_FILTER, LONG)])),
    Query("pattern_transactions", q_pattern_transactions,
          _cols(PAYMENT4 + [(SCOPE, KEEP), (PATTERN_AMOUNT, MONEY), (STATUS, KEEP)])),
    Query("recurrence_horizon", q_recurrence_horizon, _cols(HORIZON_COLS)),
    Query("live_recurrences", q_live_recurrences, _cols(HORIZON_COLS)),
    Query("lapsed_recurrences", q_lapsed_recurrences, _cols(HORIZON_COLS)),
    Query("lapsed_to_nonrecurrent", q_lapsed_to_nonrecurrent, _cols(PAYMENT4)),
    Query("regularity_class", q_regularity_class, _cols(CLASS_COLS)),
    Query("categorized_recurrences", q_categorized_recurrences, _cols(CATEGORY_COLS)),
    Query("nonrecurrent_monthly", q_nonrecurrent_monthly,
          _cols([(CUSTOMER, KEEP), (YEAR, LONG), (MONTH, LONG), (SUM_IMPORTE, MONEY)])),
    Query("monthly_percentile", q_monthly_percentile,
          _cols([(CUSTOMER, KEEP), (YEAR, LONG), (MONTH, LONG), (SUM_IMPORTE, MONEY),
                 (PERCENTILE, FLOAT), (NUM_ROWS, LONG), (PERCENTILE_IM, MONEY)])),
    Query("nonrecurrent_level", q_nonrecurrent_level, _cols([(CUSTOMER, KEEP), (MONTH_IM, RATIO)])),
    Query("unified_recurrences", q_unified_recurrences, _cols(RECURRENCE)),
    Query("expected_payment", q_expected_payment,
          _cols([(CUSTOMER, KEEP), (CALENDAR_DATE, KEEP), (EXPECTED_AMOUNT, FLOAT)])),
    Query("recurrent_calendar", q_recurrent_calendar,
          _cols([(CUSTOMER, KEEP), (CALENDAR_DATE, KEEP), (EXPECTED_AMOUNT, FLOAT)])),
    Query("recurrent_calendar_wide", q_recurrent_calendar_wide, lambda s: _wide(s, FLOAT)),
    Query("nonrecurrent_calendar", q_nonrecurrent_calendar,
          _cols([(CUSTOMER, KEEP), (CALENDAR_DATE, KEEP), (MONTH_IM, RATIO)])),
    Query("nonrecurrent_calendar_wide", q_nonrecurrent_calendar_wide, lambda s: _wide(s, RATIO)),
    Query("stage_counts", q_stage_counts, _cols([("stage", KEEP), ("rows", LONG)])),
    Query("fit", q_fit, _cols(FIT_COLS)),
    Query("predict", q_predict, _cols(PREDICT_COLS)),
    # Other mappings of the test tables: volume (lineitem) and short, tied histories (events),
    # both with the reference date taken from the data.
    Query("fit_lineitem", q_fit, _cols(FIT_COLS), F2),
    Query("predict_lineitem", q_predict, _cols(PREDICT_COLS), F2),
    Query("pattern_statistics_lineitem", q_pattern_statistics, _cols(STATS), F2),
    Query("payment_sequence_lineitem", q_payment_sequence, _cols(SEQUENCE), F2),
    Query("nonrecurrent_monthly_lineitem", q_nonrecurrent_monthly,
          _cols([(CUSTOMER, KEEP), (YEAR, LONG), (MONTH, LONG), (SUM_IMPORTE, MONEY)]), F2),
    Query("payment_sequence_events", q_payment_sequence, _cols(SEQUENCE), F3),
    Query("pattern_statistics_events", q_pattern_statistics, _cols(STATS), F3),
    Query("categorized_recurrences_events", q_categorized_recurrences, _cols(CATEGORY_COLS), F3),
    Query("predict_events", q_predict, _cols(PREDICT_COLS), F3),
    # Missing and degenerate values (NULL merchants and amounts, zero amounts,
    # NULL reversal keys) on the customer-derived rows.
    Query("transaction_projection_gaps", q_transaction_projection, _cols(TX_COLUMNS), F4),
    Query("active_customers_gaps", q_active_customers, _cols(TX_COLUMNS), F4),
    Query("stage_counts_gaps", q_stage_counts, _cols([("stage", KEEP), ("rows", LONG)]), F4),
    Query("net_of_reversals_gaps", q_net_of_reversals, _cols(TX_COLUMNS), F4),
    Query("categorized_recurrences_gaps", q_categorized_recurrences, _cols(CATEGORY_COLS), F4),
    Query("pattern_statistics_gaps", q_pattern_statistics, _cols(STATS), F4),
    Query("payment_sequence_gaps", q_payment_sequence, _cols(SEQUENCE), F4),
    Query("payment_blocks_gaps", q_payment_blocks, _cols(BLOCK_COLS), F4),
    Query("nonrecurrent_monthly_gaps", q_nonrecurrent_monthly,
          _cols([(CUSTOMER, KEEP), (YEAR, LONG), (MONTH, LONG), (SUM_IMPORTE, MONEY)]), F4),
    Query("predict_gaps", q_predict, _cols(PREDICT_COLS), F4),
    # Whole and partial reversals on the rows of lineitem and events.
    Query("net_of_reversals_lineitem_returns", q_net_of_reversals, _cols(TX_COLUMNS), F5),
    Query("stage_counts_lineitem_returns", q_stage_counts, _cols([("stage", KEEP), ("rows", LONG)]), F5),
    Query("pattern_statistics_lineitem_returns", q_pattern_statistics, _cols(STATS), F5),
    Query("nonrecurrent_monthly_lineitem_returns", q_nonrecurrent_monthly,
          _cols([(CUSTOMER, KEEP), (YEAR, LONG), (MONTH, LONG), (SUM_IMPORTE, MONEY)]), F5),
    Query("predict_lineitem_returns", q_predict, _cols(PREDICT_COLS), F5),
    Query("net_of_reversals_event_returns", q_net_of_reversals, _cols(TX_COLUMNS), F6),
    Query("stage_counts_event_returns", q_stage_counts, _cols([("stage", KEEP), ("rows", LONG)]), F6),
    Query("predict_event_returns", q_predict, _cols(PREDICT_COLS), F6),
]

BY_NAME = {q.name: q for q in QUERIES}


def run(query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir, query.source)
    return present(query.build(ctx), query.columns(query.source))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.name: (lambda spark, sf_dir, q=q: run(q, spark, sf_dir)) for q in QUERIES}
