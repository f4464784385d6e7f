"""A pattern holding a third of all rows, mostly copies of a few payments."""

from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.operators import patterns, prepare, sequence
from cadence.plans.model import fit
from cadence.sources.schema import AMOUNT, DATE, PATTERN_KEYS, STATUS
from tests.helpers import frame, tx_row

D0 = date(2022, 1, 3)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    rows = []
    # hot pair: 3000 payments on 40 days, few distinct amounts (many copies)
    for i in range(3000):
        day = D0 + timedelta(days=7 * int(rng.integers(0, 40)))
        rows.append(tx_row(1, 1, day, float(rng.choice([9.99, 10.0, 10.01])), "DB"))
    # 6000 ordinary payments of 300 other customers
    for i in range(6000):
        c = 2 + int(rng.integers(0, 300))
        day = D0 + timedelta(days=int(rng.integers(0, 280)))
        rows.append(tx_row(c, int(rng.integers(1, 4)), day, float(rng.integers(1, 40)),
                           "CR" if rng.random() < 0.3 else "DB"))
    return frame(spark, rows)


def test_hot_pattern_statistics_equal_row_by_row(spark, skewed):
    model = fit(skewed, D0 + timedelta(days=280))
    net = prepare.net_of_reversals(skewed)
    pays = sequence.scoped_payments(prepare.marked_recurring_daily(net), prepare.not_marked(net))
    w = Window.partitionBy(*PATTERN_KEYS).orderBy(DATE, AMOUNT)
    rows = pays.select(*PATTERN_KEYS, DATE, AMOUNT, F.datediff(F.col(DATE), F.lag(DATE).over(w)).alias("gap"))
    amount = F.col(AMOUNT).cast("float")
    naive = rows.groupBy(*PATTERN_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(amount).cast("float").alias("mean_amount"),
        F.stddev(amount).cast("float").alias("sd_amount"),
        F.avg(F.col("gap").cast("float")).cast("float").alias("mean_gap"),
        F.stddev(F.col("gap").cast("float")).cast("float").alias("sd_gap"))
    fast = patterns.pattern_statistics(model.days).select(
        *PATTERN_KEYS, "nu_payments", "MEAN_transaction_amount", "SD_transaction_amount",
        "MEAN_DIFF_DAYS", "SD_days_diff")
    a = {tuple(r[:4]): tuple(r[4:]) for r in naive.collect()}
    b = {tuple(r[:4]): tuple(r[4:]) for r in fast.collect()}
    assert a.keys() == b.keys()
    hot = (1, 1, "COMMERCE", None)
    assert a[hot][0] == 3000
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert x == y or (x is not None and y is not None and x == pytest.approx(y, rel=1e-6)), (k, a[k], b[k])


def test_a_hot_day_of_distinct_amounts_is_no_task_of_its_own(spark):
    """A third of all rows at one customer, merchant and day, all amounts
    different: after the map-side combine a shuffle partition holds few rows."""
    rows = [tx_row(1, 1, D0, 1 + i / 100, "DB") for i in range(2000)]
    rows += [tx_row(2 + i % 400, 1 + i % 3, D0 + timedelta(days=i % 90), 5 + i % 7, "DB") for i in range(4000)]
    groups = sequence.day_groups(frame(spark, rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = groups.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert dealt[0] < 0.5 * dealt[1]
    assert groups.where("customer_id = 1").count() == 1
    day = patterns.pattern_days(groups).where("customer_id = 1").first()
    assert day["day_payments"] == 2000 and day["_f_n"] == 2000
    expect = np.var([np.float32(1 + i / 100) for i in range(2000)], dtype=np.float64) * 2000
    assert day["_f_m2"] == pytest.approx(expect, rel=1e-9)


def test_hot_pattern_is_classified(spark, skewed):
    model = fit(skewed, D0 + timedelta(days=280))
    hot = model.patterns.where((F.col("customer_id") == 1) & (F.col("commerce_affiliation_id") == 1))
    assert hot.count() == 1
    assert hot.first()[STATUS] in {"HARD", "SOFT", "IRREGULAR", "UNCLASSIFIED", "LAPSED"}
