"""Row-level sequence variables against a row-by-row computation in Python."""

from collections import Counter
from datetime import date, timedelta

import pytest

from cadence.operators import sequence
from cadence.sources.schema import PAIR_KEYS, TRIPLE_KEYS

D0 = date(2021, 5, 1)
SCHEMA = "customer_id bigint, commerce_affiliation_id int, transaction_amount decimal(12,2), operation_date date"


def by_hand(rows, keys):
    """Sort each group by (date, amount) and walk it."""
    idx = {"customer_id": 0, "commerce_affiliation_id": 1, "transaction_amount": 2}
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[idx[k]] for k in keys), []).append(r)
    pairs = {}
    for r in rows:
        pairs.setdefault((r[0], r[1]), []).append(r)
    out = []
    for g in groups.values():
        g = sorted(g, key=lambda r: (r[3], r[2]))
        n = len(g)
        for i, r in enumerate(g):
            prev = g[i - 1] if i else None
            gap = (r[3] - prev[3]).days if prev else None
            same_before = sum(1 for q in g[:i] if q == r)
            order2 = sum(1 for q in pairs[(r[0], r[1])] if (q[3], q[2]) >= (r[3], r[2])) - same_before
            out.append((r[0], r[1], r[2], r[3], gap, prev[2] if prev else None, r[3].day, n, i + 1, order2))
    return out


def rows_with_copies():
    rows = []
    for _ in range(10):
        rows.append((1, 1, 5, D0))
    for _ in range(3):
        rows.append((1, 1, 7, D0))
    rows.append((1, 1, 2, D0 + timedelta(days=3)))
    for _ in range(8):
        rows.append((1, 1, 9, D0 + timedelta(days=3)))
    for d in range(4):
        rows.append((1, 2, 4, D0 + timedelta(days=7 * d)))
    for _ in range(5):
        rows.append((2, 1, 1, D0 + timedelta(days=1)))
    return rows


@pytest.mark.parametrize("keys", [PAIR_KEYS, TRIPLE_KEYS])
@pytest.mark.parametrize("chunk", [3, 4096])
def test_sequence_with_copies(spark, monkeypatch, chunk, keys):
    monkeypatch.setattr(sequence, "CHUNK", chunk)
    from decimal import Decimal
    rows = [(c, m, Decimal(a).quantize(Decimal("0.01")), d) for c, m, a, d in rows_with_copies()]
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter(tuple(r) for r in sequence.payment_sequence(df, keys).collect())
    assert got == Counter(by_hand(rows, keys))


def test_position_from_the_end_counts_copies(spark):
    from decimal import Decimal
    rows = [(1, 1, Decimal("5.00"), D0)] * 3 + [(1, 1, Decimal("9.00"), D0 + timedelta(days=2))]
    out = sequence.payment_sequence(spark.createDataFrame(rows, SCHEMA), TRIPLE_KEYS).collect()
    assert sorted(r["order2"] for r in out) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="debit_type"):
        sequence.payment_sequence(spark.createDataFrame(rows, SCHEMA), ["customer_id", "debit_type"])
    with pytest.raises(ValueError, match="needs a key"):
        sequence.payment_sequence(spark.createDataFrame(rows, SCHEMA), [])


def test_many_distinct_amounts_on_one_day(spark):
    """The positions are those of one walk over the day."""
    from decimal import Decimal
    rows = [(1, 1, Decimal(i * 7919 % 5000).scaleb(-2), D0) for i in range(700)] + [(1, 1, None, D0)] * 2
    rows += [(1, 1, Decimal("1.00"), D0 + timedelta(days=1)), (2, 5, Decimal("3.00"), D0)]
    rows = [(c, m, None if a is None else a.quantize(Decimal("0.01")), d) for c, m, a, d in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    low = [(c, m, Decimal(-1) if a is None else a, d) for c, m, a, d in rows]
    expect = Counter(tuple(None if x == Decimal(-1) else x for x in r) for r in by_hand(low, PAIR_KEYS))
    assert Counter(tuple(r) for r in sequence.payment_sequence(df, PAIR_KEYS).collect()) == expect


def test_amount_sequence_on_day_sums(spark):
    from decimal import Decimal
    rows = [(1, 1, Decimal("5.00"), D0 + timedelta(days=30 * k)) for k in range(4)]
    rows += [(1, 1, Decimal("6.00"), D0 + timedelta(days=30 * k + 1)) for k in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter(tuple(r) for r in sequence.payment_sequence(df, TRIPLE_KEYS).collect())
    assert got == Counter(by_hand(rows, TRIPLE_KEYS))


def test_any_keys_and_order(spark):
    """Against Spark's own windows over the rows, which one task would walk."""
    from decimal import Decimal

    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = [(i % 7 if i % 11 else None, i % 3 if i % 5 else None, None if i % 13 == 0 else Decimal(i * 37 % 90).scaleb(-1),
             D0 + timedelta(days=i * 5 % 40), "CR" if i % 4 else None) for i in range(400)]
    rows += rows[:120] + [rows[3]] * 30
    df = spark.createDataFrame(rows, SCHEMA + ", debit_type string")
    payment = ["customer_id", "commerce_affiliation_id", "transaction_amount", "operation_date"]
    for keys, order in ((["commerce_affiliation_id"], ["operation_date"]), (["customer_id"], ["transaction_amount"]),
                        (["debit_type", "operation_date"], ["customer_id", "transaction_amount"]),
                        (["transaction_amount"], ["debit_type", "operation_date"])):
        ties = [c for c in dict.fromkeys([*order, "operation_date", "transaction_amount", *payment[:2], "debit_type"]) if c not in keys]
        walk = Window.partitionBy(*keys).orderBy(*ties)
        shown = [c for c in dict.fromkeys([*payment, *keys, *order])]
        end = [c for c in dict.fromkeys(["operation_date", "transaction_amount", *shown]) if c not in payment[:2]]
        expect = df.select(*payment, F.datediff("operation_date", F.lag("operation_date").over(walk)).alias("gap"),
                           F.lag("transaction_amount").over(walk), F.dayofmonth("operation_date"),
                           F.count(F.lit(1)).over(Window.partitionBy(*keys)), F.row_number().over(walk),
                           F.row_number().over(Window.partitionBy(*payment[:2]).orderBy(*[F.col(c).desc_nulls_last() for c in end])))
        got = sequence.payment_sequence(df, keys, order).collect()
        # The copies of a block are the same payment: which copy has which of both positions is open.
        a, b = Counter(tuple(r)[:-1] for r in got), Counter(tuple(r)[:-1] for r in expect.collect())
        assert a == b, (keys, order, list((a - b).items())[:3], list((b - a).items())[:3])
        of = lambda rows: Counter(tuple(r)[:4] + (r[-1],) for r in rows)
        assert of(got) == of(expect.collect())


def test_one_hot_group_lies_in_many_ranges(spark):
    """All payments on one day of one pair, two thirds of them copies of one."""
    df = spark.range(30_000).selectExpr(
        "1L as customer_id", "1 as commerce_affiliation_id",
        "cast(if(id % 3 = 0, id, 5) as decimal(12,2)) as transaction_amount", "date'2021-05-01' as operation_date")
    from pyspark.sql import functions as F
    chunks = sequence.in_chunks(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c")), "_c")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = sequence.written(chunks.repartitionByRange("customer_id", "operation_date", "transaction_amount", "_chunk")
                                  .withColumn("_range", F.spark_partition_id()), "t").groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
        assert len(ranges) >= 6 and max(r["n"] for r in ranges) < 3 * min(r["n"] for r in ranges)
        out = sequence.payment_sequence(df, PAIR_KEYS)
        got = out.agg(F.count(F.lit(1)), F.countDistinct("order"), F.min("order"), F.max("order"),
                      F.sum((F.col("order") + F.col("order2") != 30_001).cast("int"))).first()
        assert tuple(got) == (30_000, 30_000, 1, 30_000, 0)
        wrong = out.selectExpr("impoper_f > transaction_amount as w", "impoper_f is null as f").groupBy("w", "f").count().collect()
        assert sorted((str(r["w"]), r["f"], r["count"]) for r in wrong) == [("False", False, 29_999), ("None", True, 1)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
