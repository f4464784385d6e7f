"""Single rules of the model on hand-written tables."""

from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.functions.forecast import expected_payment
from cadence.functions.dates import horizon
from cadence.plans.model import fit
from cadence.sources.schema import CUSTOMER, COMMERCE, MONTH_IM, STATUS
from tests.helpers import frame, payments, tx_row

D0 = date(2020, 1, 1)


def expected_by_hand(day, begin, amount, last, delta, sd, factor=2):
    """The forecast rule written out in plain Python."""
    position = (day - last).days % delta
    if position == 0:
        position = delta
    next_payment = int(delta - position)
    spread = factor * sd
    if next_payment == int(spread):
        return amount
    if begin == day and (next_payment < spread or next_payment >= delta - spread):
        return amount
    return 0.0


def test_expected_payment_matches_rule_by_hand(spark):
    rng = np.random.default_rng(7)
    rows = []
    begin = date(2021, 3, 1)
    for i in range(400):
        delta = float(np.float32(rng.uniform(1, 40)))
        sd = float(np.float32(rng.choice([0.0, rng.uniform(0, 3), rng.uniform(3, 30)])))
        last = begin + timedelta(days=int(rng.integers(-60, 20)))   # also after the first day
        day = begin + timedelta(days=int(rng.integers(0, 30)))
        amount = float(np.float32(rng.uniform(1, 500)))
        rows.append((i, day, last, delta, sd, amount))
    df = spark.createDataFrame(rows, "i int, day date, last date, delta float, sd float, amount float")
    got = dict(df.select("i", expected_payment(F.col("day"), F.lit(begin), F.col("amount"), F.col("last"),
                                                F.col("delta"), F.col("sd")).alias("e")).collect())
    for i, day, last, delta, sd, amount in rows:
        want = float(np.float32(expected_by_hand(day, begin, amount, last, delta, sd)))
        assert got[i] == pytest.approx(want), (day, last, delta, sd)


def test_expected_payment_cycle_position_zero_counts_as_full_cycle(spark):
    # last payment 30 days before, mean gap 30: position 0 -> full cycle, next payment 0 == int(2*0)
    df = spark.createDataFrame([(date(2021, 1, 31), date(2021, 1, 1), 30.0, 0.0, 5.0)],
                               "day date, last date, delta float, sd float, amount float")
    e = df.select(expected_payment(F.col("day"), F.lit(date(2021, 1, 15)), F.col("amount"),
                                   F.col("last"), F.col("delta"), F.col("sd"))).first()[0]
    assert e == 5.0


def test_horizon_truncates_sd_and_mean_separately(spark):
    df = spark.createDataFrame([(date(2021, 1, 1), 2.9, 30.9)], "last date, sd float, mean float")
    h = df.select(horizon(F.col("last"), F.col("sd"), F.col("mean"), 2)).first()[0]
    assert h == date(2021, 1, 1) + timedelta(days=2 * 2 + 30)


def _status(model):
    return {(r[CUSTOMER], r[COMMERCE], r["scope"]): r[STATUS]
            for r in model.patterns.select(CUSTOMER, COMMERCE, "scope", STATUS).collect()}


def test_regularity_classes(spark):
    rows = []
    rows += payments(1, 1, D0, [30, 30, 30])          # equal gaps: hard
    rows += payments(2, 1, D0, [20, 40, 21])          # range 20 < mean 27, spread: soft
    rows += payments(3, 1, D0, [5, 60])               # range 55 > mean 32.5: irregular
    rows += payments(4, 1, D0, [10, 30])              # range 20 == mean 20: unclassified
    rows += payments(5, 1, D0 - timedelta(days=300), [30, 30, 30])  # stopped long ago: lapsed
    rows += payments(6, 1, D0, [30])                  # two payments: single
    # keep customers 5 active with a later, unrelated payment
    rows.append(tx_row(5, 9, D0 + timedelta(days=80), 3))
    as_of = D0 + timedelta(days=85)
    st = _status(fit(frame(spark, rows), as_of))
    assert st[(1, 1, "COMMERCE")] == "HARD"
    assert st[(2, 1, "COMMERCE")] == "SOFT"
    assert st[(3, 1, "COMMERCE")] == "IRREGULAR"
    assert st[(4, 1, "COMMERCE")] == "UNCLASSIFIED"
    assert st[(5, 1, "COMMERCE")] == "LAPSED"
    assert st[(6, 1, "COMMERCE")] == "SINGLE"


def test_unclassified_pattern_is_in_no_output(spark):
    rows = payments(4, 1, D0, [10, 30], amount=25)
    model = fit(frame(spark, rows), D0 + timedelta(days=45))
    assert model.recurrences.count() == 0
    assert model.monthly.count() == 0


def test_marked_payments_form_amount_patterns(spark):
    rows = payments(1, 7, D0, [30, 30, 30, 30], amount=12.5, debit="CR")
    rows += [tx_row(1, 7, D0 + timedelta(days=120), 1, debit="CR")]  # same day: summed to 13.5
    st = _status(fit(frame(spark, rows), D0 + timedelta(days=95)))
    # 12.5 occurs on four days 30 apart (amount pattern); 13.5 once, so it is a commerce row
    assert st[(1, 7, "AMOUNT")] == "HARD"
    assert st[(1, 7, "COMMERCE")] == "SINGLE"


def test_dissimilar_and_zero_mean_amounts(spark):
    rows = []
    for i, amt in enumerate([10, 100, 10, 100]):
        rows.append(tx_row(1, 1, D0 + timedelta(days=30 * i), amt))
    for i, amt in enumerate([5, -5, 5, -5]):             # mean 0: CV undefined, not similar
        rows.append(tx_row(2, 1, D0 + timedelta(days=30 * i), amt))
    for i, amt in enumerate([10, 10.5, 10, 10.5]):       # similar
        rows.append(tx_row(3, 1, D0 + timedelta(days=30 * i), amt))
    st = _status(fit(frame(spark, rows), D0 + timedelta(days=95)))
    assert st[(1, 1, "COMMERCE")] == "DISSIMILAR"
    assert st[(2, 1, "COMMERCE")] == "DISSIMILAR"
    assert st[(3, 1, "COMMERCE")] == "HARD"


def test_reversals_remove_the_whole_group_null_keys_included(spark):
    rows = payments(1, 1, D0, [30, 30, 30], amount=20)
    original = rows[1]
    reversal = list(original)
    reversal[6] = "1420"
    rows.append(tuple(reversal))
    # a group whose operation id is NULL: NULLs group together
    nul = list(tx_row(1, 2, D0, 7))
    nul[1] = None
    rev = list(nul)
    rev[6] = "1430"
    rows += [tuple(nul), tuple(rev)]
    model = fit(frame(spark, rows), D0 + timedelta(days=95))
    net = model.net
    assert net.count() == 3
    assert net.where(F.col("operation_id").isNull()).count() == 0


def test_null_debit_type_is_in_neither_half(spark):
    rows = payments(1, 1, D0, [30, 30, 30], amount=20, debit=None)
    rows.append(tx_row(1, 2, D0 + timedelta(days=80), 1))
    model = fit(frame(spark, rows), D0 + timedelta(days=95))
    assert model.patterns.where(F.col(COMMERCE) == 1).count() == 0


def test_commerce_pattern_without_commerce_is_dropped(spark):
    rows = payments(1, None, D0, [30, 30, 30], amount=20)
    rows += payments(2, None, D0, [30], amount=20)       # two payments: kept as non-recurrent
    model = fit(frame(spark, rows), D0 + timedelta(days=95))
    st = {r[CUSTOMER]: r[STATUS] for r in model.patterns.collect()}
    assert st == {1: "DROPPED", 2: "SINGLE"}
    assert [r[CUSTOMER] for r in model.monthly.select(CUSTOMER).distinct().collect()] == [2]


def test_level_is_the_unique_largest_month(spark):
    rows = []
    # customer 1: months with 100, 300, 200 -> level 300/30
    for m, amt in [(1, 100), (2, 300), (3, 200)]:
        rows.append(tx_row(1, m, date(2020, m, 5), amt))      # one merchant per month: single payments
    # customer 2: largest month tied -> no level
    for m, amt in [(1, 300), (2, 300), (3, 200)]:
        rows.append(tx_row(2, m, date(2020, m, 5), amt))
    # customer 3: one month only -> that month
    rows.append(tx_row(3, 1, date(2020, 3, 5), 90))
    model = fit(frame(spark, rows), date(2020, 3, 31))
    level = {r[CUSTOMER]: r[MONTH_IM] for r in model.level.collect()}
    assert level[1] == Decimal("10.000000")
    assert level[2] is None
    assert level[3] == Decimal("3.000000")


def test_empty_horizon_is_rejected(spark):
    model = fit(frame(spark, payments(1, 1, D0, [30, 30])), D0)
    with pytest.raises(ValueError):
        model.predict(date(2020, 5, 1), date(2020, 5, 1))


def test_rows_after_the_reference_date_count_unless_cut(spark):
    from cadence.config import RecurrenceConfig
    rows = payments(1, 1, D0, [30, 30, 30])                  # last payment D0 + 90
    as_of = D0 + timedelta(days=60)
    kept = fit(frame(spark, rows), as_of)
    cut = fit(frame(spark, rows), as_of, RecurrenceConfig(cut_after_reference=True))
    assert kept.patterns.first()["nu_payments"] == 4
    assert cut.patterns.first()["nu_payments"] == 3


def test_types_that_decide_results_are_checked(spark):
    from pyspark.sql import functions as F

    from cadence.sources.transactions import conform
    df = frame(spark, [tx_row(1, 1, date(2020, 1, 1), 5)])
    assert conform(df).count() == 1
    for column, kind in (("operation_date", "timestamp"), ("transaction_amount", "double"), ("message_type", "int")):
        with pytest.raises(TypeError, match=column):
            conform(df.withColumn(column, F.col(column).cast(kind)))


def test_every_column_is_reconciled(spark):
    from pyspark.sql import functions as F

    from cadence.sources.schema import TRANSACTION_COLUMNS
    from cadence.sources.transactions import transaction_projection
    df = frame(spark, [tx_row(1, 1, date(2020, 1, 1), 5)])
    for column in TRANSACTION_COLUMNS:
        with pytest.raises(TypeError, match=column):
            transaction_projection(df.withColumn(column, F.array(column)))
        with pytest.raises(ValueError, match=column):
            transaction_projection(df.drop(column))
    with pytest.raises(ValueError, match="customer_id"):
        transaction_projection(df.select("*", "customer_id"))
    both = df.withColumn("operation_id", F.array("operation_id")).withColumn("return_type", F.lit(1.5))
    with pytest.raises(TypeError, match="operation_id .* return_type"):
        transaction_projection(both)
    other = df.select(F.lit("extra").alias("month"), *reversed(df.columns)).withColumn("customer_id", F.col("customer_id").cast("string"))
    assert transaction_projection(other).columns == TRANSACTION_COLUMNS
    assert fit(other.withColumn("operation_time_date", F.lit("2020-01-01").cast("timestamp"))).patterns.count() == 1


@pytest.mark.parametrize("checkpoint", [False, True])
@pytest.mark.parametrize("name", ["customer", "gaps"])
def test_observed_counts_equal_the_counting_query(spark, name, checkpoint):
    from cadence.plans.queries import F1, F4, context, q_stage_counts
    from tests.conftest import SF_SMALL
    source = {"customer": F1, "gaps": F4}[name]
    c = context(spark, SF_SMALL, source)
    expect = {r["stage"]: r["rows"] for r in q_stage_counts(c).collect() if not r["stage"].startswith("without")}
    model = fit(c.tx, source.as_of, checkpoint=checkpoint, observe=True)
    if not checkpoint:
        forecast = model.forecast(source.begin, source.end)
        assert sorted(map(str, forecast.collect())) == sorted(map(str, c.model.forecast(source.begin, source.end).collect()))
    assert model.counts() == expect
    with pytest.raises(RuntimeError, match="observe"):
        c.model.counts()


def test_reference_date_with_a_time_is_the_day(spark):
    from datetime import datetime

    from cadence.functions.dates import as_date
    row = spark.range(1).select(as_date(date(2020, 4, 30)).alias("a"), as_date(datetime(2020, 4, 30, 12)).alias("b")).first()
    assert row["a"] == row["b"] == date(2020, 4, 30)


def test_due_days_are_the_days_that_are_tested_due(spark):
    """Against a test of every day, for whole and fractional gaps, wide spreads,
    last payments before, in and after the horizon."""
    import random

    from pyspark.sql import functions as F

    from cadence.functions.forecast import due_days, is_due
    rng = random.Random(8)
    begin, rows = date(2020, 2, 20), []
    for i in range(600):
        gap = rng.choice([0.4, 1.0, 1.5, 7.0, 29.5, 30.0, 30.333334, 365.0, rng.uniform(0.2, 90)])
        rows.append((i, begin + timedelta(days=rng.randint(-400, 90)), gap, rng.choice([0.0, 0.5, 1.2, 3.0, rng.uniform(0, 60)])))
    df = spark.createDataFrame(rows, "i int, last date, gap float, sd float")
    for length in (1, 30, 120):
        end = begin + timedelta(days=length)
        days = F.sequence(F.lit(begin), F.lit(end - timedelta(days=1)), F.expr("interval 1 day"))
        tested = F.filter(days, lambda d: is_due(d, F.lit(begin), F.col("last"), F.col("gap"), F.col("sd")))
        found = F.array_sort(due_days(begin, end, F.col("last"), F.col("gap"), F.col("sd")))
        assert df.where(~found.eqNullSafe(tested)).collect() == []


def test_unknown_amounts_in_the_calendar(spark):
    """A day is NULL only where every recurrence of the customer is due with an
    unknown amount; in the original such a sum has no value."""
    from pyspark.sql import functions as F

    from cadence.operators import calendar
    begin, end = date(2020, 1, 1), date(2020, 1, 11)
    rec = spark.createDataFrame([(1, None, date(2019, 12, 27), 10.0, 0.0), (2, None, date(2019, 12, 27), 10.0, 0.0),
                                 (2, 5.0, date(2019, 12, 29), 10.0, 0.0), (3, None, date(2019, 12, 27), 10.0, 0.0),
                                 (3, None, date(2019, 12, 27), 10.0, 0.0)],
                                "customer_id long, imp_oper float, max_fec_trans date, delta_avg float, delta_std float")
    expect = calendar.expected_payments(rec, begin, end).groupBy("customer_id", "calendar_date").agg(F.sum("expected_amount").alias("e"))
    got = calendar.recurrent_calendar(rec, begin, end)
    assert sorted(map(str, got.collect())) == sorted(map(str, expect.withColumnRenamed("e", "expected_amount").collect()))
    assert got.where("expected_amount is null").count() == 2
    wide = calendar.recurrent_calendar_wide(rec, begin, end).collect()
    assert len(wide) == 3 and len(wide[0]) == 11
