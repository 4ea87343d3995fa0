"""Exact division and rounding on decimals.

Spark's own ``avg`` keeps four extra digits for decimals and returns a double for integers, so an
average that is rounded afterwards may land on the wrong side of a tie. Every average and rate is
therefore an exact sum divided once by an exact count, in decimal, and rounded half up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# decimal(28,10) / decimal(20,0) keeps 20 fractional digits in Spark's result-type rules.
_NUMERATOR = T.DecimalType(28, 10)
_DENOMINATOR = T.DecimalType(20, 0)

MONEY = T.DecimalType(20, 2)
RATE = T.DecimalType(20, 2)
# Stands for a NUMERIC without declared scale.
WIDE = T.DecimalType(28, 10)
# Fractional days; 16 digits keep the value in one machine word.
DAYS = T.DecimalType(16, 10)


def ratio(num: Column, den: Column, digits: int = 10) -> Column:
    """``num / den`` rounded half up to ``digits``; NULL where ``den`` is NULL or 0."""
    quotient = num.cast(_NUMERATOR) / F.nullif(den.cast(_DENOMINATOR), F.lit(0).cast(_DENOMINATOR))
    return F.round(quotient, digits).cast(T.DecimalType(28 if digits > 2 else 20, digits))


def cents(money: Column) -> Column:
    """Money as whole cents. Integer sums are cheaper than decimal ones and exact up to 9.2e16."""
    return (money * 100).cast("bigint")


def from_cents(amount: Column) -> Column:
    return (amount.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def money_percent(num: Column, den: Column) -> Column:
    return ratio(num.cast(MONEY) * 10_000, cents(den), 2)


def percent(num: Column, den: Column) -> Column:
    return ratio(num.cast(_NUMERATOR) * 100, den, 2)


def mean(column: Column, digits: int = 10) -> Column:
    """Exact average of the non-NULL values, as an aggregate expression."""
    return ratio(F.sum(column), F.count(column), digits)

