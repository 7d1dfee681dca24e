"""Guarded ratios and exact averages.

Money stays DECIMAL up to the final ratio, so sums do not depend on the order
in which partitions are merged; ratios are DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def at_least_one(column) -> Column:
    """Denominator guard: NULL and everything below 1 count as 1."""
    return F.greatest(_col(column).cast("double"), F.lit(1.0))


def ratio(numerator, denominator, digits: int | None = 2) -> Column:
    """numerator / max(denominator, 1), rounded."""
    value = _col(numerator).cast("double") / at_least_one(denominator)
    return value if digits is None else F.round(value, digits)


def percent(numerator, denominator, digits: int = 2) -> Column:
    """100 * numerator / max(denominator, 1), rounded."""
    return F.round(ratio(numerator, denominator, None) * F.lit(100.0), digits)


def exact_avg(column) -> Column:
    """Average as exact sum over count; NULL for an empty group."""
    value = _col(column)
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def money_sum(column, precision: int = 18) -> Column:
    return F.sum(_col(column)).cast(f"decimal({precision},2)")
