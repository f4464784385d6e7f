"""Hand-written transaction tables for single rules."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from cadence.sources.schema import TRANSACTION_SCHEMA

_op = [0]


def tx_row(customer, commerce, day: date, amount, debit="DB", message="1200", operation=None):
    _op[0] += 1
    op = operation if operation is not None else _op[0]
    amt = None if amount is None else Decimal(str(amount)).quantize(Decimal("0.01"))
    return (customer, op, "00", debit, 0, commerce, message, day, op % 86400, amt,
            op * 7, op, "A", "T", "0", amt)


def payments(customer, commerce, start: date, gaps, amount=10, debit="DB"):
    """Rows at ``start`` and then after each gap in ``gaps`` (days)."""
    rows, day = [tx_row(customer, commerce, start, amount, debit)], start
    for g in gaps:
        day = day + timedelta(days=g)
        rows.append(tx_row(customer, commerce, day, amount, debit))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)
