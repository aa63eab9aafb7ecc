"""Exact money arithmetic. Stored amounts are DECIMAL(15,2); sums keep Spark's widened DECIMAL(25,2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"
MONEY_SUM = "decimal(25,2)"
SHARE = "decimal(5,2)"


def money_sum(amount: Column) -> Column:
    """Sum that cannot overflow below 10^23 and always has the same type, also over sums."""
    return F.sum(amount).cast(MONEY_SUM)


def count_sum(n: Column) -> Column:
    return F.sum(n).cast("bigint")


def ratio_or_zero(total: Column, parts: Column) -> Column:
    """Rounded quotient; 0 when there is nothing to divide by."""
    return F.when(parts > 0, F.round(total / parts, 2)).otherwise(0).cast(MONEY_SUM)


def ratio_or_null(total: Column, parts: Column) -> Column:
    """Rounded quotient; NULL when the divisor is 0."""
    return F.round(total / F.nullif(parts, F.lit(0)), 2).cast(MONEY_SUM)


def percent(part: Column, whole: Column, kind: str = SHARE) -> Column:
    """``part`` as a percentage of ``whole``, half-up to 2 places; NULL when ``whole`` is 0.

    Worked out on whole cents, because a decimal quotient of two wide sums keeps too few places to be rounded again.
    """
    p = (part * 100).cast("decimal(27,0)")
    w = (whole * 100).cast("decimal(27,0)")
    scaled = F.abs(p) * F.lit(20000).cast("decimal(5,0)") + F.abs(w)
    hundredths = F.call_function("div", scaled, F.nullif(F.abs(w) * 2, F.lit(0)))
    sign = (F.signum(p) * F.signum(w)).cast("int")
    return (hundredths * sign * F.lit(0.01).cast("decimal(3,2)")).cast(kind)
