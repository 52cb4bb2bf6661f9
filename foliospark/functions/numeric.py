"""Rounding, division and sums that give one answer however Spark splits the work."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,10)"
ADDEND = "decimal(37,10)"  # two of them add up to EXACT


def half_up(value: Column, digits: int = 2) -> Column:
    """Spark's ROUND: half away from zero on the shortest decimal form of a double, as a double."""
    return F.round(value.cast("double"), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return half_up(ratio(numerator, denominator) * F.lit(100.0), digits)


def millions(value: Column, digits: int = 2) -> Column:
    return half_up(value / F.lit(1_000_000.0), digits)


def _totals(value: Column) -> tuple[Column, Column, Column]:
    """The exact sum as a decimal, the sum of what no decimal holds as a double, and the plain sum; NULL where there is no value.

    Whole cents, which most amounts are, add up as integers; only other values go through the far slower
    conversion to decimal(38,10). What no decimal holds are NaN, infinities, values beyond that type and values it would take
    to zero. The exact sum is NULL if it overflows; then the plain sum counts. No part is used more than
    it must be: the size of these trees is most of what planning a rollup costs.
    """
    value = value.cast("double")
    cents = F.floor(value * F.lit(100.0) + F.lit(0.5))
    whole = (F.abs(value) < F.lit(1e13)) & (cents / F.lit(100.0) == value)
    other = F.when(~whole, value)
    exact = other.try_cast(EXACT)
    in_cents = F.sum(F.when(whole, cents).otherwise(F.lit(0)).cast("decimal(18,0)"))
    others = F.try_sum(F.coalesce(exact, F.lit(0).cast(EXACT))).try_cast(ADDEND)
    total = (in_cents * F.lit(Decimal("0.01"))).try_cast(ADDEND) + others
    rest = F.sum(F.when(exact.isNull() | (exact == 0), other))
    return total, F.coalesce(rest, F.lit(0.0)), F.sum(value)


def exact_sum(value: Column) -> Column:
    """Sum of a double, as a double: the order in which partial sums meet does not change it.

    Each value counts to ten decimal places. NaN, infinities and values a decimal cannot hold are
    added as doubles, so they show in the result as in Spark's own sum.
    """
    total, rest, plain = _totals(value)
    return F.when(F.count(value) > 0, F.coalesce(total.cast("double") + rest, plain))


def money_sum(value: Column, digits: int = 2) -> Column:
    """Rounded total of an amount, as a double."""
    total, rest, plain = _totals(value)
    exact = F.when(rest == 0, F.round(total, digits).cast("double"))
    rounded = F.coalesce(exact, F.round(F.coalesce(total.cast("double") + rest, plain), digits))
    return F.when(F.count(value) > 0, rounded)


def exact_avg(value: Column) -> Column:
    """Mean as an exact total over the number of non-NULL values; NULL when there are none."""
    return ratio(exact_sum(value), F.count(value))


def rounded_avg(value: Column, digits: int = 2) -> Column:
    return half_up(exact_avg(value), digits)


def weighted_avg(value: Column, weight: Column) -> Column:
    """``exact_avg`` of rows that each stand for ``weight`` equal ones."""
    return ratio(exact_sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def count_if(condition: Column, weight: Column | None = None) -> Column:
    """Rows for which the condition holds: NULL on an empty input, as SUM(CASE ...) gives.

    With ``weight`` each row stands for that many.
    """
    return F.sum(F.when(condition, F.lit(1) if weight is None else weight).otherwise(0))


def sum_if(condition: Column, value: Column) -> Column:
    """Total of a value over the rows for which the condition holds, other rows adding zero."""
    return exact_sum(F.when(condition, value).otherwise(F.lit(0)))
