"""Large tables: the work is dealt over a number of partitions that follows the rows,
with the results that the session's own shuffles give."""

from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.config import DEFAULT_CONFIG
from cadence.operators import patterns, prepare, sequence
from cadence.plans.model import fit
from cadence.plans import queries
from cadence.plans.queries import BY_NAME, F1, F2, F4, F5, present
from cadence.sources import testdata
from cadence.sources.schema import PAIR_KEYS
from cadence.sources.transactions import conform
from tests.conftest import SF_SMALL
from tests.helpers import frame, tx_row

D0 = date(2022, 1, 3)
DEALT = replace(DEFAULT_CONFIG, partitions=7)


def rows_of(df):
    return sorted(map(repr, (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())))


@pytest.mark.parametrize("source", [F1, F4, F5], ids=lambda s: s.name)
def test_dealt_results_equal_those_of_the_sessions_shuffles(spark, source):
    tx = conform(source.load(spark, SF_SMALL))
    plain, dealt = fit(tx, source.as_of), fit(tx, source.as_of, DEALT)
    cols = BY_NAME["pattern_statistics"].columns(source)
    assert rows_of(dealt.all_net) == rows_of(plain.all_net)
    assert rows_of(present(dealt.patterns, cols)) == rows_of(present(plain.patterns, cols))
    assert rows_of(dealt.patterns.select("status", "CV_filter")) == rows_of(plain.patterns.select("status", "CV_filter"))
    assert rows_of(dealt.forecast(source.begin, source.end)) == rows_of(plain.forecast(source.begin, source.end))
    blocks, dealt_blocks = plain.active_blocks(), dealt.active_blocks()
    assert rows_of(dealt_blocks) == rows_of(blocks)
    assert rows_of(dealt.active_payments()) == rows_of(plain.active_payments())
    commerce = sequence.commerce_scope(blocks)
    assert (rows_of(sequence.payment_sequence(commerce, PAIR_KEYS, partitions=7))
            == rows_of(sequence.payment_sequence(commerce, PAIR_KEYS)))


def test_dealt_types_are_the_same(spark):
    tx = conform(F1.load(spark, SF_SMALL))
    types = [[(f.name, f.dataType) for f in fit(tx, F1.as_of, c).pattern_rows.schema] for c in (DEFAULT_CONFIG, DEALT)]
    assert types[0] == types[1]


def test_a_hot_day_is_merged_from_its_salts(spark):
    rows = [tx_row(1, 1, D0, 1 + i / 100, "DB") for i in range(2000)]
    rows += [tx_row(2, 1, D0 + timedelta(days=i), 0.1, "DB") for i in range(40)] + [tx_row(2, 1, D0, 0.1, "DB") for _ in range(50)]
    tx = frame(spark, rows)
    spread = sequence.dealt_by_pair(tx, 7).where("customer_id = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 1500
    days = patterns.pattern_days(sequence.day_groups(tx, DEALT))
    day = days.where("customer_id = 1").first()
    values = [np.float32(1 + i / 100) for i in range(2000)]
    assert day["day_payments"] == 2000 and day["_f_m2"] == pytest.approx(np.var(values, dtype=np.float64) * 2000, rel=1e-9)
    assert all(r["_f_m2"] < 1e-25 for r in days.where("customer_id = 2").collect())


def shuffles(df):
    """(keys, number of partitions) of every shuffle in the plan."""
    lines = [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(" in x]
    return [int(x.split("hashpartitioning(")[1].split("), ")[0].rsplit(", ", 1)[1]) for x in lines]


def test_what_holds_rows_is_dealt_over_the_given_partitions(spark, tmp_path):
    """13 partitions wherever rows, day groups or patterns are sorted; the session's 8
    remain for the distinct reversals and the customers of the activity filter."""
    path = str(tmp_path / "tx.parquet")
    F1.load(spark, SF_SMALL).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        model = fit(spark.read.parquet(path), F1.as_of, replace(DEFAULT_CONFIG, partitions=13))
        assert set(shuffles(prepare.net_of_reversals(model.transactions, model.config).drop("x"))) == {8, 13}
        assert shuffles(model.pattern_rows).count(8) == 3      # reversals twice, customers
        assert shuffles(model.forecast(F1.begin, F1.end)).count(8) == shuffles(model.pattern_rows).count(8)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.debug.maxToStringFields", "25")


def test_partitions_follow_the_rows(spark, monkeypatch):
    assert testdata.partitions(spark, SF_SMALL, "customer") is None and testdata.partitions(spark, SF_SMALL, "lineitem") is None
    monkeypatch.setattr(testdata, "TASK_ROWS", 50)
    wanted = testdata.partitions(spark, SF_SMALL, "customer")
    assert wanted == max(spark.sparkContext.defaultParallelism, -(-150 * 17 // 50))
    base = testdata._spread(spark, SF_SMALL, "customer")
    assert base.rdd.getNumPartitions() == wanted and base.count() == 150
    assert rows_of(F2.load(spark, SF_SMALL)) == rows_of(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").transform(
        lambda l: testdata.transaction_projection(spark.sql(testdata.F2_SQL, lineitem=l, orders=spark.read.parquet(f"{SF_SMALL}/orders.parquet")))))


def context(spark, source, config):
    raw = source.load(spark, SF_SMALL)
    tx = conform(raw)
    return queries.Context(spark, source, raw, tx, fit(tx, source.as_of, config))


@pytest.mark.parametrize("name", ["similar_amount_recurrences", "pattern_transactions", "stage_counts"])
def test_dealt_queries_equal_those_of_the_sessions_shuffles(spark, name):
    plain, dealt = (present(BY_NAME[name].build(context(spark, F4, c)), BY_NAME[name].columns(F4)) for c in (DEFAULT_CONFIG, DEALT))
    assert dealt.schema.simpleString() == plain.schema.simpleString() and rows_of(dealt) == rows_of(plain)


@pytest.mark.parametrize("name", ["predict", "unified_recurrences", "similar_amount_recurrences", "pattern_transactions", "stage_counts"])
def test_what_grows_with_the_rows_is_not_broadcast(spark, name):
    """Spark's estimate of these transactions is that of the few customers they come of,
    so any join that is left to it is a broadcast."""
    found = BY_NAME[name].build(context(spark, F1, replace(DEFAULT_CONFIG, partitions=13)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan and "LeftSemi" not in plan and "LeftAnti" not in plan
    assert "cast(_key" not in plan and "cast(_of" not in plan      # as dealt, not once more by the session's shuffles


def test_a_key_is_dealt_over_several_tasks_for_a_join(spark):
    rows = spark.range(4000).selectExpr("if(id < 3000, 1, id) as customer_id", "if(id % 2 = 0, null, 5) as c", "id as n")
    keyed = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (3500, None, "c"), (3501, None, "d"), (9999, 5, "e")], "customer_id long, c int, flag string")
    joined = prepare.joined_by_key(rows, keyed, ["customer_id", "c"], ["n"], 61)
    assert joined.columns == ["customer_id", "c", "n", "flag"]
    assert {r["flag"]: r["count"] for r in joined.groupBy("flag").count().collect()} == {"a": 1500, "b": 1500, "c": 1}
    tasks = joined.where("flag = 'a'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 1100


def test_the_groups_of_the_ranges_are_dealt(spark):
    """Group by group and range by range over 13 partitions; the session's 8 are left to
    the join with the few groups that lie in several ranges."""
    rows = spark.createDataFrame([(i % 50, 1, D0 + timedelta(days=i // 50), i) for i in range(1000)],
                                 "customer_id int, commerce_affiliation_id int, operation_date date, n int")
    rows = rows.withColumn("transaction_amount", F.lit(10).cast("decimal(12,2)")).drop("n")
    found = sequence.payment_sequence(rows, PAIR_KEYS, partitions=13)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = shuffles(found)
        assert counts.count(13) >= 3 and counts.count(8) <= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found.count() == 1000 and found.agg(F.max("order"), F.max("nu_payments")).first()[:] == (20, 20)


def new_shuffles(df, key):
    """Shuffles by ``key`` that are computed, not taken from another branch."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return sum(f"Exchange hashpartitioning({key}#" in x and "ReusedExchange" not in x for x in lines)


def test_the_branches_of_the_counts_share_the_shuffles_of_the_rows(spark, monkeypatch):
    """Reference date, raw, active and reversal-free rows, payments and patterns: one dealing
    of each table and one of the rows by operation (the other is that of the distinct
    reversals); only what is counted of a row is dealt by customer."""
    expect = rows_of(queries.registry()["stage_counts_lineitem_returns"](spark, SF_SMALL))
    monkeypatch.setattr(testdata, "TASK_ROWS", 500)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        found = queries.registry()["stage_counts_lineitem_returns"](spark, SF_SMALL)
        assert {k: new_shuffles(found, k) for k in ("l_orderkey", "o_orderkey", "_operation", "_reversed")} == {
            "l_orderkey": 1, "o_orderkey": 1, "_operation": 2, "_reversed": 1}
        assert rows_of(found) == expect
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.debug.maxToStringFields", "25")


@pytest.mark.parametrize("source", [F1, F4, F5], ids=lambda s: s.name)
def test_dealt_rows_of_active_customers_are_the_same(spark, source):
    tx = conform(source.load(spark, SF_SMALL))
    plain, dealt = fit(tx, source.as_of), fit(tx, source.as_of, DEALT)
    expect = rows_of(plain.net)
    assert rows_of(dealt.net) == expect
    for config in (DEFAULT_CONFIG, DEALT):
        assert rows_of(prepare.prepared(tx, plain.as_of, config, reversals_first=True)) == expect
    assert rows_of(prepare.active_customers(tx, dealt.as_of, DEALT)) == rows_of(prepare.active_customers(tx, plain.as_of))


def test_blocks_are_dealt_once_for_the_sums_and_the_window(spark, tmp_path):
    """Marked day-sums that repeat lie apart by day and salt; equal unmarked payments and
    unknown amounts beside them."""
    rows = [tx_row(1, c, D0 + timedelta(days=d), a, "CR") for c in (1, None) for d in range(5) for a in (3, 4)]
    rows += [tx_row(1, 1, D0 + timedelta(days=d), a, "DB") for d in (0, 0, 1, 2, 3) for a in (7, None)]
    rows += [tx_row(2, 1, D0 + timedelta(days=d), None, "CR") for d in range(4)] + [tx_row(2, 1, D0, 7, "CR")]
    frame(spark, rows).write.parquet(str(tmp_path / "tx"))
    net = spark.read.parquet(str(tmp_path / "tx"))
    blocks = sequence.payment_blocks(net, DEALT)
    assert shuffles(blocks) == [7, 7]
    assert blocks.columns == sequence.payment_blocks(net).columns and rows_of(blocks) == rows_of(sequence.payment_blocks(net))
    assert blocks.where("scope = 'AMOUNT' and pattern_amount = 7").count() == 10 and blocks.where("payments = 2").count() == 2


def test_a_table_is_read_as_dealt_with_all_its_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(testdata, "TASK_ROWS", 2)
    rows = spark.createDataFrame([(None, None), (1, None), (None, 2), (3, 4), (3, 4)], "o_orderkey long, o_custkey long")
    for name in ("orders", "lineitem"):
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    dealt = testdata._spread(spark, str(tmp_path), "orders", "o_orderkey", like="lineitem", columns=testdata.ORDERS_COLUMNS)
    assert rows_of(dealt) == rows_of(rows) and dealt.where("o_custkey > 2").count() == 2
