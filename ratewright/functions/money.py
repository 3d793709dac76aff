"""Exact fixed-point money.

Amounts are DECIMAL(18,2) at the table boundary. Inside a plan they travel as
whole cents (or millionths after a pro-rata split) in BIGINT: the sums are exact
whatever the row order, and they run on primitives in generated code, where a
wide decimal would allocate an object per addition. ANSI mode raises on overflow.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MICRO_MONEY = "decimal(18,6)"


def to_cents(amount: Column) -> Column:
    """Whole cents of a two-decimal amount (exact below 2e13 units).

    ``rint`` stays on primitives; ``round`` of a double goes through BigDecimal.
    """
    return F.rint(amount.cast("double") * 100).cast("bigint")


def from_cents(cents: Column, dtype: str = MONEY) -> Column:
    return (cents * F.lit(Decimal("0.01"))).cast(dtype)


def from_micros(micros: Column, dtype: str = MICRO_MONEY) -> Column:
    return (micros * F.lit(Decimal("0.000001"))).cast(dtype)


def div_floor(numerator: Column, denominator: Column | int) -> Column:
    """Integer division; NULL where the denominator is zero."""
    d = F.lit(denominator) if isinstance(denominator, int) else denominator
    return F.call_function("div", numerator, F.nullif(d.cast("bigint"), F.lit(0).cast("bigint")))


def div_round(numerator: Column, denominator: Column) -> Column:
    """Integer division rounded half away from zero, for a non-negative denominator."""
    doubled = F.abs(numerator) * 2 + denominator
    return F.signum(numerator).cast("bigint") * div_floor(doubled, denominator * 2)


def prorate_micros(cents: Column, part: Column, whole: Column) -> Column:
    """``cents * part / whole`` in millionths of a currency unit."""
    return div_round(cents * part.cast("bigint") * 10_000, whole.cast("bigint"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio; NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def ratio_if_positive(numerator: Column, denominator: Column) -> Column:
    """Double ratio; NULL unless the denominator is above zero."""
    d = denominator.cast("double")
    return F.when(d > 0, numerator.cast("double") / d)
