"""Parameters of the recurrence model."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class RecurrenceConfig:
    # Defaults of the original model.
    months_back: int = 3             # activity window before the reference date
    min_payments: int = 3            # a pattern needs more than 2 payments
    cv_limit: float = 0.5            # similar amounts: CV of the last payments below this
    recent_payments: int = 4         # how many last payments the CV looks at
    sre_limit: float = 0.045         # hard below, soft above (SRE of the day gaps)
    sd_factor: int = 2               # horizon and forecast spread in standard deviations
    level_days: int = 30             # divisor from a month to a daily level
    reversal_message_type: str = "1420"  # message types >= this one are reversals
    marked_debit_type: str = "CR"    # debit type of payments marked as recurring
    default_begin: date = date(2017, 4, 30)
    default_end: date = date(2017, 5, 30)
    # Not in the original model, which keeps rows dated after the reference
    # date: set to drop them before fitting.
    cut_after_reference: bool = False
    # Number of partitions to which rows, day groups and patterns are dealt, for large
    # tables (``testdata.partitions`` takes it from the row count). None leaves it to the
    # session, whose shuffles hold more in a task the larger the table is.
    partitions: int | None = None


DEFAULT_CONFIG = RecurrenceConfig()
