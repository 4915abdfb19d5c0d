from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def greatest_strict(*values: Column) -> Column:
    """Largest value, NULL as soon as one argument is NULL (Spark skips NULLs)."""
    complete = values[0].isNotNull()
    for value in values[1:]:
        complete = complete & value.isNotNull()
    return F.when(complete, F.greatest(*values))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division of exact operands; NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def mean_of(total: Column, count: Column) -> Column:
    """Mean from an exact sum and a count, so that partial sums never lose cents."""
    return ratio(total, count)


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Quotient of two exact numbers rounded half away from zero, as a decimal.

    Worked out in whole units, because Spark cuts the scale of a wide decimal
    division before ``round`` could see the digits.
    """
    scaled = F.abs(numerator) * F.lit(2 * 10**digits)
    size = F.abs(denominator)
    units = F.call_function("div", scaled + size, size * F.lit(2))
    signed = units * F.signum(numerator).cast("bigint") * F.signum(denominator).cast("bigint")
    return (signed * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(24,{digits})")
