"""Reversals on the rows of lineitem and events, against a plain grouping."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadence.operators.prepare import net_of_reversals
from cadence.plans.queries import F5, F6
from cadence.sources.schema import REVERSAL_KEYS
from cadence.sources.transactions import conform
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("source", [F5, F6], ids=lambda s: s.name)
def test_reversed_groups_go_and_all_others_stay(spark, source):
    tx = conform(source.load(spark, SF_SMALL))
    columns = [*REVERSAL_KEYS, "message_type"]
    rows = [tuple(r) for r in tx.select(columns).collect()]
    reversed_keys = {r[:-1] for r in rows if r[-1] is not None and r[-1] >= "1420"}
    expected = sorted((r for r in rows if r[:-1] not in reversed_keys), key=repr)
    found = sorted((tuple(r) for r in net_of_reversals(tx).select(columns).collect()), key=repr)
    assert found == expected
    # Some payment is reversed, some is not, and each kind of message is there.
    assert {r[-1] for r in rows} == {"1200", "1400", "1420"}
    assert 0 < sum(r[-1] == "1200" for r in found) < sum(r[-1] == "1200" for r in rows)


@pytest.mark.parametrize("source", [F5, F6], ids=lambda s: s.name)
def test_a_partial_reversal_leaves_its_original(spark, source):
    tx = conform(source.load(spark, SF_SMALL))
    net = net_of_reversals(tx)
    partly = tx.where((F.col("message_type") == "1420") & (F.col("transaction_amount") == 5))
    originals = net.where(F.col("message_type") == "1200").select("operation_id")
    assert partly.count() > 0
    assert partly.join(originals, "operation_id", "left_anti").count() == 0
    assert net.where(F.col("message_type") == "1420").count() == 0


@pytest.mark.parametrize("source", [F5, F6], ids=lambda s: s.name)
def test_the_raw_rows_may_give_the_reversals(spark, source):
    """Reversal keys from the raw rows drop the same rows of a customer subset."""
    tx = conform(source.load(spark, SF_SMALL))
    some = tx.where(F.col("customer_id") % 2 == 0)
    own, wider = net_of_reversals(some), net_of_reversals(some, reversals_from=tx)
    assert own.exceptAll(wider).count() == 0 and wider.exceptAll(own).count() == 0
