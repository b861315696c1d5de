"""Money as whole cents, so that sums and means are exact."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    """An amount (decimal, or double with two decimals) as whole cents, half away from zero.

    ``floor`` stays in plain arithmetic; ``round`` would build a big decimal per row.
    """
    size = F.floor(F.abs(amount) * 100 + F.lit(Decimal("0.5"))).cast("bigint")
    return F.when(amount < 0, -size).otherwise(size)


def whole_div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, denominator)


def half_up_mean(total: Column, count: Column) -> Column:
    """``total / count`` to the nearest whole number, halves away from zero; 0 for no rows."""
    size = F.abs(total)
    mean = whole_div(2 * size + count, 2 * count)
    return F.when(count == 0, F.lit(0).cast("bigint")).when(total < 0, -mean).otherwise(mean)


def hundredths_text(units: Column) -> Column:
    """123456 -> ``1234.56``, never in exponent form."""
    return (units.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("string")
