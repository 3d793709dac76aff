"""Frequency, severity, trend, pure premium and the indicated rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.functions.money import ratio
from ratewright.functions.segments import SEGMENT, segment_columns
from ratewright.operators.exposure import DAYS_PER_YEAR
from ratewright.operators.ultimate import YEAR_KEYS

HALF_YEAR_DAYS = 182


def fct_frequency_severity(
    selected_count: DataFrame, selected_loss: DataFrame, policy_exposure: DataFrame
) -> DataFrame:
    counts = selected_count.select(
        *YEAR_KEYS, F.col("method").alias("claim_count_method"), "ultimate_claim_count"
    )
    losses = selected_loss.select(*YEAR_KEYS, F.col("method").alias("loss_method"), "ultimate_loss")
    exposure = policy_exposure.select(
        *SEGMENT,
        F.col("calendar_year").alias("accident_year"),
        F.col("total_earned_exposure").cast("double").alias("total_earned_exposure"),
    )
    return (
        counts.join(losses, YEAR_KEYS)
        .join(exposure, YEAR_KEYS, "left")
        .select(
            *YEAR_KEYS,
            "claim_count_method",
            "loss_method",
            "total_earned_exposure",
            ratio(F.col("ultimate_claim_count"), F.col("total_earned_exposure")).alias("frequency"),
            ratio(F.col("ultimate_loss"), F.col("ultimate_claim_count")).alias("severity"),
        )
    )


def _trend_years(start: str, end: str) -> Column:
    """Years from the middle of the accident year to the middle of the priced year."""
    half = F.round(F.datediff(end, start) / 2).cast("int")
    middle = F.date_add(F.date_add(F.col(start), half), HALF_YEAR_DAYS)
    years = F.year(middle) + F.dayofyear(middle) / F.lit(DAYS_PER_YEAR) - (F.col("accident_year") + 0.5)
    return F.greatest(years, F.lit(0.0))


def fct_frequency_severity_trended(frequency_severity: DataFrame, trend_selection: DataFrame) -> DataFrame:
    """Frequency and severity carried to the rate period; without a trend row they stay."""

    def trend(kind: str, prefix: str) -> DataFrame:
        return trend_selection.where(F.col("trend_type") == kind).select(
            *SEGMENT,
            F.col("annual_trend").alias(f"{prefix}_trend"),
            F.col("effective_from").alias(f"{prefix}_from"),
            F.col("effective_to").alias(f"{prefix}_to"),
        )

    def factor(prefix: str) -> Column:
        base = 1 + F.coalesce(f"{prefix}_trend", F.lit(0.0))
        return F.pow(base, _trend_years(f"{prefix}_from", f"{prefix}_to"))

    return (
        frequency_severity.join(trend("frequency", "freq"), SEGMENT, "left")
        .join(trend("severity", "sev"), SEGMENT, "left")
        .select(
            *YEAR_KEYS,
            "total_earned_exposure",
            (F.col("frequency") * factor("freq")).alias("trended_frequency"),
            (F.col("severity") * factor("sev")).alias("trended_severity"),
        )
    )


def fct_pure_premium(trended: DataFrame) -> DataFrame:
    return trended.withColumn("pure_premium", F.col("trended_frequency") * F.col("trended_severity"))


def fct_indicated_premium(
    pure_premium: DataFrame, expense: DataFrame, pricing_version: str | None = None
) -> DataFrame:
    """Exposure-weighted pure premium loaded for expenses and profit.

    Several pricing versions in the expense table give one row each, unless
    ``pricing_version`` names one.
    """
    if pricing_version is not None:
        expense = expense.where(F.col("pricing_version") == pricing_version)
    exposure = F.col("total_earned_exposure")
    weighted = pure_premium.groupBy(*SEGMENT).agg(
        ratio(
            F.sum(F.col("trended_frequency") * F.col("trended_severity") * exposure), F.sum(exposure)
        ).alias("pure_premium")
    )
    loaded = F.col("pure_premium") * (1 + F.col("ulae_ratio")) + F.col("fixed_expense_per_exposure")
    retained = 1 - F.col("variable_expense_ratio") - F.col("profit_ratio")
    return weighted.join(expense, "state_grp").select(*SEGMENT, ratio(loaded, retained).alias("indicated_premium"))


def current_rate(rate_history: DataFrame, version: str = "v3") -> DataFrame:
    """Average over segments of each segment's latest filed factor.

    Filings of the same date are ordered by filing id.
    """
    latest = rate_history.groupBy(*SEGMENT).agg(
        F.max_by("cumulative_factor", F.struct("effective_date", "filing_id")).alias("cumulative_factor")
    )
    return (
        latest.select(*segment_columns(version, *SEGMENT), "cumulative_factor")
        .groupBy(*SEGMENT)
        .agg(F.avg("cumulative_factor").alias("cumulative_factor"))
    )


def mart_indicated_rate_change_pure_premium(
    indicated: DataFrame, rate_history: DataFrame, version: str = "v3"
) -> DataFrame:
    """Indicated premium of each segment against the rate level now filed for it.

    A segmentation that pools everything makes the segment a constant, and a join on
    constants is a product of its sides. Both sides are stacked instead, and each
    segment's one rate is handed to its premiums by a window over the segment.
    """
    rates = current_rate(rate_history, version)
    stacked = indicated.select(*SEGMENT, "indicated_premium", F.lit(None).cast("double").alias("rate"), F.lit(0).alias("filed"))
    stacked = stacked.unionByName(
        rates.select(*SEGMENT, F.lit(None).cast("double").alias("indicated_premium"), F.col("cumulative_factor").alias("rate"), F.lit(1).alias("filed"))
    )
    own = Window.partitionBy(*SEGMENT)
    matched = stacked.dropna(subset=SEGMENT).withColumns(
        {"cumulative_factor": F.max("rate").over(own), "has_rate": F.max("filed").over(own) == 1}
    ).where("filed = 0 AND has_rate")
    return matched.select(
        *SEGMENT,
        "indicated_premium",
        "cumulative_factor",
        (ratio(F.col("indicated_premium"), F.col("cumulative_factor")) - 1).alias("indicated_rate_change"),
    )
