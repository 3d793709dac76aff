"""Claim financial state over time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.functions import dates as D
from ratewright.functions.intervals import explode_month_ends
from ratewright.functions.money import MONEY, from_cents, to_cents
from ratewright.operators.calendar import first_accident_month, month_attributes

AMOUNTS = [
    "paid_loss",
    "case_reserve",
    "paid_expense",
    "case_expense",
    "recovery",
    "incurred_loss",
]
CHANGES = [f"{a}_change" for a in AMOUNTS]
CUMULATIVE = [f"cumulative_{a}" for a in AMOUNTS]
OPEN_END = "9999-12-31"
_TOTAL = "decimal(28,2)"


def claim_financial_events(claims: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions plus one zero-amount event on each claim's report date.

    The anchor makes a reported claim exist before any money moves on it.
    """
    anchors = claims.select(
        "claim_id",
        F.col("reported_date").alias("event_date"),
        *[F.lit(0).cast(MONEY).alias(c) for c in CHANGES],
        F.lit("REPORTED_ANCHOR").alias("event_type"),
    )
    moves = transactions.select(
        "claim_id",
        F.col("transaction_date").alias("event_date"),
        *CHANGES,
        F.lit("FINANCIAL_TRANSACTION").alias("event_type"),
    )
    return anchors.unionByName(moves)


def _daily(events: DataFrame, as_of: date) -> DataFrame:
    """One row per claim and day, amounts in cents.

    Collapsing to days first bounds every claim's window by the calendar, even
    for a claim that owns a large share of all transactions: the sum combines
    on the map side, so such a claim never travels row by row.
    """
    anchor = F.col("event_type") == "REPORTED_ANCHOR"
    return (
        events.where(F.col("event_date") <= D.day(as_of))
        .groupBy("claim_id", "event_date")
        .agg(
            F.max(F.when(anchor, 1).otherwise(0)).alias("has_reported_anchor"),
            F.sum(F.when(anchor, 0).otherwise(1)).alias("financial_transaction_count"),
            *[F.coalesce(F.sum(to_cents(F.col(c))), F.lit(0)).alias(c) for c in CHANGES],
        )
    )


def claim_financial_state_cumulative(events: DataFrame, as_of: date) -> DataFrame:
    """Running position of each claim at the end of every day with an event."""
    running = Window.partitionBy("claim_id").orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    totals = _daily(events, as_of).withColumns(
        {
            "cumulative_financial_transaction_count": F.sum("financial_transaction_count").over(running),
            **{f"cumulative_{a}": F.sum(f"{a}_change").over(running) for a in AMOUNTS},
        }
    )
    recomputed = (
        F.col("cumulative_paid_loss")
        + F.col("cumulative_case_reserve")
        + F.col("cumulative_paid_expense")
        + F.col("cumulative_case_expense")
        - F.col("cumulative_recovery")
    )
    return totals.select(
        "claim_id",
        "event_date",
        "has_reported_anchor",
        "financial_transaction_count",
        "cumulative_financial_transaction_count",
        *[from_cents(F.col(c), _TOTAL).alias(c) for c in CHANGES],
        *[from_cents(F.col(c), _TOTAL).alias(c) for c in CUMULATIVE],
        from_cents(recomputed, _TOTAL).alias("calculated_cumulative_incurred"),
        (F.col("cumulative_financial_transaction_count") > 0).alias("has_financial_activity"),
    )


def claim_financial_state_period(cumulative: DataFrame) -> DataFrame:
    """Each position with the half-open period [valid_from, valid_to) it holds."""
    following = F.lead("event_date").over(Window.partitionBy("claim_id").orderBy("event_date"))
    return cumulative.withColumn("next_event_date", following).select(
        "claim_id",
        F.col("event_date").alias("valid_from_date"),
        F.coalesce("next_event_date", D.day(OPEN_END)).alias("valid_to_date"),
        F.col("next_event_date").isNull().alias("is_current_state"),
        "cumulative_financial_transaction_count",
        (F.col("cumulative_financial_transaction_count") == 0).alias("is_reported_only_state"),
        "has_financial_activity",
        *CUMULATIVE,
        "calculated_cumulative_incurred",
    )


def claim_attributes(claims: DataFrame, policy: DataFrame, coverage: DataFrame) -> DataFrame:
    """Claim with the product and coverage it belongs to."""
    holder = policy.select("policy_id", "product_id", "line_of_business")
    cover = coverage.select("coverage_id", "coverage_code")
    return (
        claims.select(
            "claim_id", "policy_id", "risk_unit_id", "coverage_id", "loss_date", "reported_date", "claim_type",
            "cause_code",
        )
        .join(holder, "policy_id")
        .join(cover, "coverage_id")
    )


def claim_valuation_snapshot(
    state_period: DataFrame,
    claims: DataFrame,
    policy: DataFrame,
    coverage: DataFrame,
    as_of: date,
    calendar_start: date,
) -> DataFrame:
    """Position of every reported claim at every month end.

    Attributes join at claim level before the periods are listed month by
    month, so the large output is produced by a narrow step and never shuffled.
    """
    states = state_period.join(claim_attributes(claims, policy, coverage), "claim_id")
    first_month = F.greatest(first_accident_month(claims), D.month_start(D.day(calendar_start)))
    monthly = explode_month_ends(states, F.col("valid_from_date"), F.col("valid_to_date"), first_month, as_of)
    return monthly.withColumns(month_attributes("valuation_month")).select(
        F.last_day("valuation_month").alias("valuation_date"),
        "valuation_month",
        "calendar_year",
        "calendar_quarter",
        "calendar_month",
        "is_quarter_end",
        "is_half_year_end",
        "is_year_end",
        "claim_id",
        "policy_id",
        "risk_unit_id",
        "coverage_id",
        "product_id",
        "line_of_business",
        "coverage_code",
        "loss_date",
        "reported_date",
        "claim_type",
        "cause_code",
        "is_reported_only_state",
        "has_financial_activity",
        "cumulative_financial_transaction_count",
        *CUMULATIVE,
        "calculated_cumulative_incurred",
    )


def claim_development(snapshot: DataFrame) -> DataFrame:
    """Snapshot with accident periods and development ages in months.

    A claim valued in the month of its accident period's start has age 1.
    """
    loss = F.col("loss_date")
    periods = {
        "month": ("accident_month", D.month_start(loss), "development_age_monthly"),
        "quarter": ("accident_quarter", D.quarter_start(loss), "development_age_quarterly"),
        "half": ("accident_half_year", D.half_year_start(loss), "development_age_half_year"),
        "year": ("accident_year", D.year_start(loss), "development_age_annual"),
    }
    valuation = F.col("valuation_month")
    return snapshot.withColumns(
        {
            **{name: start for name, start, _ in periods.values()},
            **{age: D.month_boundaries(start, valuation) + 1 for _, start, age in periods.values()},
        }
    )


def claim_snapshot(
    states: DataFrame, claims: DataFrame, as_of: date, calendar_start: date, year_end_only: bool = False
) -> DataFrame:
    """Latest position per claim at or before each valuation date.

    ``year_end_only`` keeps the year ends and ``as_of`` itself.

    The latest row not after a date is the row whose period contains that date,
    so the periods replace a join on ``<=`` with a top-1 per claim and date.
    """
    following = F.lead("event_date").over(Window.partitionBy("claim_id").orderBy("event_date"))
    periods = states.select(
        "claim_id",
        F.col("event_date").alias("transaction_date"),
        F.coalesce(following, D.day(OPEN_END)).alias("valid_to"),
        F.col("cumulative_paid_loss").alias("cumulative_paid"),
        F.col("cumulative_case_reserve").alias("case_reserve"),
        F.col("cumulative_incurred_loss").alias("incurred"),
    )
    owner = claims.select("claim_id", "policy_id", F.col("loss_date").alias("accident_date"))
    joined = periods.join(owner, "claim_id")
    first_month = F.greatest(first_accident_month(claims), D.month_start(D.day(calendar_start)))
    monthly = explode_month_ends(joined, F.col("transaction_date"), F.col("valid_to"), first_month, as_of)
    if year_end_only:
        last = F.col("valuation_month") == D.month_start(D.day(as_of))
        monthly = monthly.where(D.is_year_end_month(F.col("valuation_month")) | last)
    return monthly.select(
        F.last_day("valuation_month").alias("valuation_date"),
        "claim_id",
        "policy_id",
        "accident_date",
        "transaction_date",
        "cumulative_paid",
        "case_reserve",
        "incurred",
    )
