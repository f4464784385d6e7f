"""Statistic expressions shared by the pattern operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_float(c: Column) -> Column:
    """32-bit float, the precision at which the model keeps its statistics.

    The float cast also absorbs last-digit noise of a standard deviation before
    it is truncated to whole days.
    """
    return c.cast("float")


def spread_root(n: Column) -> Column:
    """The root in the standard relative error ``sd / (sqrt(n) * mean)``."""
    return F.sqrt(n.cast("double"))


def relative_error(sd: Column, n: Column, mean: Column) -> Column:
    """Standard relative error; NULL when the mean is 0."""
    return F.try_divide(sd.cast("double"), spread_root(n) * mean.cast("double"))


def sample_sd_from_moments(m: Column, s1: Column, s2: Column) -> Column:
    """Sample standard deviation of ``m`` integers with sum ``s1`` and sum of
    squares ``s2``, from exact integer arithmetic: ``(m*s2 - s1^2) / (m*(m-1))``.

    Used for day gaps, which are integers; the numerator is exact in
    DECIMAL(38,0), so the result does not suffer from cancellation.
    """
    m_dec = m.cast("decimal(38,0)")
    numerator = m_dec * s2.cast("decimal(38,0)") - s1.cast("decimal(38,0)") * s1.cast("decimal(38,0)")
    variance = F.try_divide(numerator.cast("double"), (m_dec * (m_dec - 1)).cast("double"))
    return F.sqrt(variance)
