"""Calendar arithmetic on DATE columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: date | str) -> Column:
    return F.lit(value).cast("date")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def quarter_start(c: Column) -> Column:
    return F.trunc(c, "quarter")


def half_year_start(c: Column) -> Column:
    return F.make_date(F.year(c), F.when(F.month(c) <= 6, 1).otherwise(7), F.lit(1))


def year_start(c: Column) -> Column:
    return F.trunc(c, "year")


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def actual_end(expiration: Column, cancellation: Column) -> Column:
    """End of cover: the earlier of expiration and cancellation, if cancelled."""
    return F.least(expiration, F.coalesce(cancellation, expiration))


def completed_age(birth: Column, at: Column) -> Column:
    """Full years between two dates, counting the birthday itself."""
    before_birthday = F.date_format(at, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(at) - F.year(birth) - F.when(before_birthday, 1).otherwise(0)


def is_quarter_end_month(c: Column) -> Column:
    return F.month(c).isin(3, 6, 9, 12)


def is_half_year_end_month(c: Column) -> Column:
    return F.month(c).isin(6, 12)


def is_year_end_month(c: Column) -> Column:
    return F.month(c) == 12
