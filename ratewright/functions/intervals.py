"""Interval joins as linear expansions.

A join of half-open intervals to a calendar is an inequality join, which Spark
runs as a nested loop. Each interval knows its own months, so it can list them
with ``sequence`` and ``explode``: no join, no shuffle, work linear in the output.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewright.functions.dates import day, month_start


def _month_list(first: Column, last: Column) -> Column:
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.when(first <= last, months)


def explode_months(
    df: DataFrame, start: str, end: str, calendar_start: date, calendar_end: date, name: str = "calendar_month"
) -> DataFrame:
    """One row per calendar month overlapping [start, end).

    A month overlaps when it starts before ``end`` and its successor starts
    after ``start``. A zero-length interval inside a month keeps that month; at
    a month's first day it has none.
    """
    first = F.greatest(month_start(F.col(start)), month_start(day(calendar_start)))
    last = F.least(month_start(F.date_sub(F.col(end), 1)), month_start(F.date_sub(day(calendar_end), 1)))
    return df.withColumn(name, F.explode(_month_list(first, last)))


def explode_month_ends(
    df: DataFrame, valid_from: Column, valid_to: Column, first_month: Column, as_of: date, name: str = "valuation_month"
) -> DataFrame:
    """One row per month whose last day lies in [valid_from, valid_to), up to ``as_of``."""
    first = F.greatest(month_start(valid_from), first_month)
    last_complete = F.add_months(month_start(F.date_add(day(as_of), 1)), -1)
    last = F.least(F.add_months(month_start(valid_to), -1), last_complete)
    return df.withColumn(name, F.explode(_month_list(first, last)))


def explode_years(df: DataFrame, first: Column, last: Column, name: str = "calendar_year") -> DataFrame:
    """One row per integer year in [first, last]."""
    years = F.when(first <= last, F.sequence(first, last))
    return df.withColumn(name, F.explode(years))
