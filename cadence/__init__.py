"""Recurrent-payment analytics on Spark: find payments that repeat at the same
merchant, keep the regular and live ones, forecast them as a daily calendar and
give every customer a flat level for the rest of the spending."""

from cadence.config import DEFAULT_CONFIG, RecurrenceConfig
from cadence.plans.model import RecurrenceModel, fit, predict

__all__ = ["RecurrenceConfig", "DEFAULT_CONFIG", "RecurrenceModel", "fit", "predict"]
