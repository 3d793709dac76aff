"""Earned exposure and earned premium."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.functions.dates import actual_end
from ratewright.functions.intervals import explode_months, explode_years
from ratewright.functions.money import div_round, from_micros, prorate_micros, to_cents
from ratewright.functions.segments import SEGMENT, segment_columns

DAYS_PER_YEAR = 365.25


def coverage_active_period(
    coverage: DataFrame, policy: DataFrame, risk_unit: DataFrame, bound_by_parents: bool = False
) -> DataFrame:
    """Coverage with its policy and risk unit and the date cover really ended.

    ``bound_by_parents`` also clips the period to the policy and the risk unit.
    """
    holder = policy.select(
        "policy_id",
        "product_id",
        "line_of_business",
        "primary_state",
        "underwriting_tier",
        "cancellation_date",
        F.col("effective_date").alias("policy_effective"),
        F.col("expiration_date").alias("policy_expiration"),
    )
    unit = risk_unit.select(
        "risk_unit_id",
        "risk_unit_type",
        "exposure_unit",
        F.col("effective_date").alias("unit_effective"),
        F.col("expiration_date").alias("unit_expiration"),
    )
    starts = F.col("effective_date")
    ends = actual_end(F.col("expiration_date"), F.col("cancellation_date"))
    if bound_by_parents:
        starts = F.greatest(starts, F.col("policy_effective"), F.col("unit_effective"))
        ends = F.least(ends, F.col("policy_expiration"), F.col("unit_expiration"))
    return (
        coverage.join(holder, "policy_id")
        .join(unit, "risk_unit_id")
        .select(
            "coverage_id",
            "policy_id",
            "risk_unit_id",
            "product_id",
            "line_of_business",
            "primary_state",
            "underwriting_tier",
            "risk_unit_type",
            "exposure_unit",
            "coverage_code",
            "coverage_family",
            starts.alias("coverage_effective_date"),
            F.col("expiration_date").alias("scheduled_expiration_date"),
            ends.alias("actual_expiration_date"),
        )
    )


def coverage_month(active_period: DataFrame, calendar_start: date, calendar_end: date) -> DataFrame:
    """Active period split at month starts, with the days active in each month."""
    split = explode_months(
        active_period, "coverage_effective_date", "actual_expiration_date", calendar_start, calendar_end
    )
    month = F.col("calendar_month")
    starts = F.greatest(F.col("coverage_effective_date"), month)
    ends = F.least(F.col("actual_expiration_date"), F.add_months(month, 1))
    return split.select(
        "coverage_id",
        "policy_id",
        "risk_unit_id",
        "product_id",
        "line_of_business",
        "primary_state",
        "underwriting_tier",
        "risk_unit_type",
        "exposure_unit",
        "coverage_code",
        "coverage_family",
        "calendar_month",
        starts.alias("exposure_start"),
        ends.alias("exposure_end"),
        F.datediff(ends, starts).alias("active_days"),
    )


def earned_exposure_month(coverage_months: DataFrame) -> DataFrame:
    """Years of exposure per coverage and month."""
    return coverage_months.groupBy("policy_id", "risk_unit_id", "coverage_id", "calendar_month").agg(
        (F.sum("active_days").cast("double") / DAYS_PER_YEAR).alias("earned_exposure")
    )


def premium_earning_segments(premium_transaction: DataFrame, coverage: DataFrame) -> DataFrame:
    """Each premium movement earns from its date to the scheduled expiration.

    A cancellation refund is a negative segment and earns the same way.
    """
    term = coverage.select("coverage_id", F.col("expiration_date").alias("earning_end_date"))
    return premium_transaction.join(term, "coverage_id").select(
        "transaction_id",
        "policy_id",
        "coverage_id",
        "transaction_type",
        F.col("transaction_date").alias("earning_start_date"),
        "earning_end_date",
        "premium_change",
        F.datediff("earning_end_date", "transaction_date").alias("earning_days"),
    )


def earned_premium_month(
    premium_transaction: DataFrame, coverage: DataFrame, calendar_start: date, calendar_end: date
) -> DataFrame:
    """Premium earned per coverage and month, pro rata by day of each earning segment.

    Earning is linear in the amount, so movements of one coverage on one day are
    added first, combining on the map side: a coverage with very many movements
    then has at most one segment per day when it reaches the join. The join
    hashes on ``coverage_id``; the months expand and sum in place after it.
    """
    daily = (
        premium_transaction.groupBy("policy_id", "coverage_id", "transaction_date")
        .agg(F.sum(to_cents(F.col("premium_change"))).alias("cents"))
        .withColumnsRenamed({"transaction_date": "earning_start_date"})
    )
    term = coverage.select("coverage_id", F.col("expiration_date").alias("earning_end_date"))
    split = explode_months(
        daily.join(term, "coverage_id"), "earning_start_date", "earning_end_date", calendar_start, calendar_end
    )
    month = F.col("calendar_month")
    days = F.datediff(
        F.least(F.col("earning_end_date"), F.add_months(month, 1)), F.greatest(F.col("earning_start_date"), month)
    )
    earning_days = F.datediff("earning_end_date", "earning_start_date")
    return (
        split.groupBy("policy_id", "coverage_id", "calendar_month")
        .agg(F.sum(prorate_micros(F.col("cents"), days, earning_days)).alias("micros"))
        .select("policy_id", "coverage_id", "calendar_month", from_micros(F.col("micros")).alias("earned_premium"))
    )


def priced_policy(policy: DataFrame, coverage: DataFrame, vehicle: DataFrame) -> DataFrame:
    """Policy with the rating attributes that the pricing chain groups by.

    The vehicle segment is the type of the policy's first vehicle, 'NA' without
    one; the written premium is the sum over its coverages.
    """
    premium = coverage.groupBy("policy_id").agg(F.sum("written_premium").alias("written_premium"))
    first_vehicle = vehicle.groupBy("policy_id").agg(
        F.min_by("vehicle_type", F.struct("vehicle_sequence", "vehicle_id")).alias("vehicle_type")
    )
    return (
        policy.join(premium, "policy_id", "left")
        .join(first_vehicle, "policy_id", "left")
        .select(
            "policy_id",
            F.col("primary_state").alias("state"),
            F.col("underwriting_tier").alias("risk_class"),
            F.coalesce("vehicle_type", F.lit("NA")).alias("vehicle_segment"),
            "effective_date",
            "expiration_date",
            "cancellation_date",
            "term_months",
            F.coalesce("written_premium", F.lit(0)).cast("decimal(18,2)").alias("written_premium"),
        )
    )


def policy_exposure(policies: DataFrame, version: str = "v3") -> DataFrame:
    """Earned exposure and premium per segment and calendar year.

    The year is an inclusive range (to 31 December), so a policy that crosses a
    year end earns one day less than its term. Only calendar years in which
    some policy starts are reported.
    """
    ends = actual_end(F.col("expiration_date"), F.col("cancellation_date"))
    last_start = policies.agg(F.year(F.max("effective_date")).alias("year")).scalar()
    years = explode_years(
        policies.withColumn("ends", ends), F.year("effective_date"), F.least(F.year("ends"), last_start)
    )
    year = F.col("calendar_year")
    earn_start = F.greatest(F.col("effective_date"), F.make_date(year, F.lit(1), F.lit(1)))
    earn_end = F.least(F.col("ends"), F.make_date(year, F.lit(12), F.lit(31)))
    days = F.greatest(F.datediff(earn_end, earn_start), F.lit(0)).cast("bigint")
    total_days = F.datediff("ends", "effective_date").cast("bigint")
    exposure = div_round(F.col("term_months").cast("bigint") * days * 1_000_000, total_days * 12)
    premium = prorate_micros(to_cents(F.col("written_premium")), days, total_days)
    parts = years.select(
        *segment_columns(version),
        "calendar_year",
        F.coalesce(exposure, F.lit(0)).cast("decimal(19,0)").alias("exposure_micros"),
        F.coalesce(premium, F.lit(0)).cast("decimal(19,0)").alias("premium_micros"),
    )
    # whole-book totals outgrow 64 bits, so these two sums are decimal
    return parts.groupBy(*SEGMENT, "calendar_year").agg(
        from_micros(F.sum("exposure_micros"), "decimal(28,6)").alias("total_earned_exposure"),
        from_micros(F.sum("premium_micros"), "decimal(28,6)").alias("total_earned_premium"),
    )
