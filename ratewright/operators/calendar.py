"""Calendar spines and valuation dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.functions import dates as D


def calendar_bounds(spark: SparkSession, start: date, end_exclusive: date) -> DataFrame:
    return spark.range(1).select(D.day(start).alias("start_date"), D.day(end_exclusive).alias("end_date"))


def calendar_bounds_of(df: DataFrame, column: str, years_before: int = 1, years_after: int = 3) -> DataFrame:
    """Whole-year calendar bounds around the dates a table holds (one row)."""
    edges = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return edges.select(
        F.make_date(F.year("lo") - years_before, F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(F.year("hi") + years_after, F.lit(1), F.lit(1)).alias("end_date"),
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day in [start_date, end_date)."""
    day = F.col("date_day")
    spine = bounds.select(
        F.explode(F.sequence("start_date", F.date_sub("end_date", 1), F.expr("interval 1 day"))).alias("date_day")
    )
    return spine.select(
        "date_day",
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        F.day(day).alias("calendar_day"),
        D.month_start(day).alias("month_start"),
        D.quarter_start(day).alias("quarter_start"),
        D.year_start(day).alias("year_start"),
        F.when(F.month(day) <= 6, 1).otherwise(2).alias("half_year"),
    )


def month_attributes(month: str) -> dict:
    """Calendar attributes of a month, derived rather than looked up."""
    m = F.col(month)
    return {
        "calendar_year": F.year(m),
        "calendar_month": F.month(m),
        "calendar_quarter": F.quarter(m),
        "is_quarter_end": D.is_quarter_end_month(m),
        "is_half_year_end": D.is_half_year_end_month(m),
        "is_year_end": D.is_year_end_month(m),
    }


def dim_calendar_month(bounds: DataFrame) -> DataFrame:
    """One row per month that has a day in the calendar."""
    months = bounds.select(
        F.explode(
            F.sequence(
                D.month_start(F.col("start_date")),
                D.month_start(F.date_sub("end_date", 1)),
                F.expr("interval 1 month"),
            )
        ).alias("month_start")
    )
    return months.withColumns(
        {
            "month_end": F.last_day("month_start"),
            "next_month_start": F.add_months("month_start", 1),
            **month_attributes("month_start"),
        }
    )


def first_accident_month(claims: DataFrame) -> Column:
    """The month of the earliest loss, as a scalar subquery."""
    return claims.agg(D.month_start(F.min("loss_date")).alias("first_accident_month")).scalar()


def valuation_dates(calendar_months: DataFrame, claims: DataFrame, as_of: date) -> DataFrame:
    """Month ends from the first accident month to ``as_of``."""
    in_range = (F.col("month_start") >= first_accident_month(claims)) & (F.col("month_end") <= D.day(as_of))
    return calendar_months.where(in_range).select(
        F.col("month_end").alias("valuation_date"),
        F.col("month_start").alias("valuation_month"),
        "calendar_year",
        "calendar_quarter",
        "calendar_month",
        "is_quarter_end",
        "is_half_year_end",
        "is_year_end",
    )


def generate_years(df: DataFrame, column: str) -> DataFrame:
    """Every calendar year from the earliest to the latest date of a column."""
    edges = df.agg(F.year(F.min(column)).alias("lo"), F.year(F.max(column)).alias("hi"))
    return edges.select(F.explode(F.sequence("lo", "hi")).alias("calendar_year"))
