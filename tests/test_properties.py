"""Properties of the model on the test tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.operators import patterns, prepare, sequence
from cadence.plans.model import fit
from cadence.plans.queries import F1, F3
from cadence.sources.schema import (
    AMOUNT, CALENDAR_DATE, CUSTOMER, DATE, EXPECTED_AMOUNT, MONTH_IM, NU_PAYMENTS, PATTERN_KEYS,
    STATUS, SUM_IMPORTE,
)
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def f1(spark):
    return F1.load(spark, SF_SMALL).checkpoint(eager=True)


@pytest.fixture(scope="module")
def model(f1):
    return fit(f1, F1.as_of)


def test_every_payment_ends_in_exactly_one_branch(model):
    """Marked day-sums and other payments of active customers are conserved:
    each belongs to exactly one pattern, whatever its status."""
    rows = model.active_payments().count()
    assert model.patterns.agg(F.sum(NU_PAYMENTS)).first()[0] == rows
    statuses = {r[0] for r in model.patterns.select(STATUS).distinct().collect()}
    assert statuses <= {"SINGLE", "DISSIMILAR", "DROPPED", "LAPSED", "HARD", "SOFT", "IRREGULAR",
                        "UNCLASSIFIED"}
    assert {"SINGLE", "DISSIMILAR", "LAPSED", "HARD", "SOFT", "IRREGULAR"} <= statuses


def test_level_is_unique_maximum_month(model):
    by_customer = model.monthly.groupBy(CUSTOMER).agg(
        F.max(SUM_IMPORTE).alias("top"),
        F.count(F.lit(1)).alias("months"))
    ties = model.monthly.join(by_customer, CUSTOMER).where(F.col(SUM_IMPORTE) == F.col("top")) \
        .groupBy(CUSTOMER).agg(F.count(F.lit(1)).alias("at_top"))
    rule = by_customer.join(ties, CUSTOMER).select(
        CUSTOMER, F.when(F.col("at_top") == 1, F.col("top") / F.lit(30)).cast("decimal(38,6)").alias("rule"))
    got = model.level.select(CUSTOMER, F.col(MONTH_IM).cast("decimal(38,6)").alias("level"))
    diff = rule.join(got, CUSTOMER, "full").where(~F.col("rule").eqNullSafe(F.col("level")))
    assert diff.count() == 0


def test_long_calendar_equals_wide_calendar(model):
    long_rec, long_non = model.predict_long(F1.begin, F1.end)
    wide_rec, wide_non = model.predict(F1.begin, F1.end)
    dates = [c for c in wide_rec.columns if c != CUSTOMER]
    stacked = wide_rec.select(CUSTOMER, F.explode(F.map_from_arrays(
        F.array(*[F.lit(d) for d in dates]), F.array(*[F.col(f"`{d}`") for d in dates]))))
    a = {(r[0], r[1]): r[2] for r in stacked.collect()}
    b = {(r[CUSTOMER], str(r[CALENDAR_DATE])): r[EXPECTED_AMOUNT] for r in long_rec.collect()}
    assert a == b
    assert long_non.count() == wide_non.count() * len(dates)


def test_partition_count_does_not_change_results(spark, f1):
    def snapshot(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        try:
            rec, non = fit(f1.repartition(partitions), F1.as_of).predict_long(F1.begin, F1.end)
            return sorted(map(tuple, rec.collect())), sorted(map(tuple, non.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert snapshot(1) == snapshot(5)


def test_day_level_statistics_equal_row_level_statistics(spark):
    """Statistics from the day-level table against the row-by-row definition
    (window over the payments, NULL gap on the first one) on tied histories."""
    tx = F3.load(spark, SF_SMALL)
    model = fit(tx, F3.as_of)
    net = prepare.net_of_reversals(tx)
    pays = sequence.scoped_payments(prepare.marked_recurring_daily(net), prepare.not_marked(net))
    w = Window.partitionBy(*PATTERN_KEYS).orderBy(DATE, AMOUNT)
    rows = pays.select(*PATTERN_KEYS, DATE, AMOUNT,
                       F.datediff(F.col(DATE), F.lag(DATE).over(w)).alias("gap"))
    amount = F.col(AMOUNT).cast("float")
    naive = rows.groupBy(*PATTERN_KEYS).agg(
        F.avg(amount).cast("float").alias("mean_amount"),
        F.stddev(amount).cast("float").alias("sd_amount"),
        F.avg(F.col("gap").cast("float")).cast("float").alias("mean_gap"),
        F.stddev(F.col("gap").cast("float")).cast("float").alias("sd_gap"),
        F.max("gap").alias("max_gap"), F.min("gap").alias("min_gap"),
        F.stddev(F.dayofmonth(DATE).cast("float")).cast("float").alias("sd_dom"))
    fast = patterns.pattern_statistics(model.days).select(
        *PATTERN_KEYS, "MEAN_transaction_amount", "SD_transaction_amount", "MEAN_DIFF_DAYS",
        "SD_days_diff", "MAX_days_diff", "MIN_days_diff", "SD_dia_mes")
    a = {tuple(r[:4]): tuple(r[4:]) for r in naive.collect()}
    b = {tuple(r[:4]): tuple(r[4:]) for r in fast.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert x == y or (x is not None and y is not None and x == pytest.approx(y, rel=1e-6)), (k, a[k], b[k])


def test_payment_sequence_orders_ties_by_amount(spark):
    model = fit(F3.load(spark, SF_SMALL), F3.as_of)
    seq = sequence.payment_sequence(sequence.commerce_scope(model.active_payments()),
                                    ["customer_id", "commerce_affiliation_id"])
    w = Window.partitionBy("customer_id", "commerce_affiliation_id").orderBy(DATE, AMOUNT)
    check = seq.select("*", F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(
        Window.partitionBy("customer_id", "commerce_affiliation_id")).alias("n"))
    # positions are a permutation of 1..n that respects (date, amount) order
    bad = check.groupBy("customer_id", "commerce_affiliation_id").agg(
        F.sum("order").alias("s"), F.max("n").alias("n"), F.max("order").alias("mx"),
        F.sum((F.col("order") + F.col("order2") != F.col("n") + 1).cast("int")).alias("desc_bad")
    ).where((F.col("s") != F.col("n") * (F.col("n") + 1) / 2) | (F.col("mx") != F.col("n"))
            | (F.col("desc_bad") > 0))
    assert bad.count() == 0


def test_checkpointed_fit_equals_lazy_fit(spark, f1):
    lazy = fit(f1, F1.as_of).forecast(F1.begin, F1.end)
    written = fit(f1, F1.as_of, checkpoint=True)
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert folder
    assert sorted(map(tuple, lazy.collect())) == sorted(map(tuple, written.forecast(F1.begin, F1.end).collect()))
    plan = written.forecast(F1.begin, F1.end)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan   # the raw rows are not read again
