"""Numbers: exact money sums, guarded division and stable rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole part up to 10^20 and 18 places: line amounts far below a cent still count.
MONEY_TYPE = "decimal(38,18)"


def money(amount: Column) -> Column:
    """Fixed-point amount, so that sums do not depend on row order."""
    return amount.cast(MONEY_TYPE)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_away(value: Column, digits: int = 0) -> Column:
    """Round the binary double half away from zero.

    Spark's own ``round`` works on the shortest decimal text of the double and rounds
    1.005 up, although the stored number lies below it.
    """
    scale = F.lit(float(10**digits))
    number = value.cast("double")
    return F.signum(number) * F.floor(F.abs(number) * scale + F.lit(0.5)) / scale
