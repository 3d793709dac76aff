"""Conformed dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.functions.keys import surrogate_key


def dim_policy(stg_policy: DataFrame) -> DataFrame:
    return stg_policy.drop("term_months")


def dim_risk_unit(stg_policy_risk_unit: DataFrame) -> DataFrame:
    return stg_policy_risk_unit


def dim_coverage(stg_policy_coverage: DataFrame) -> DataFrame:
    return stg_policy_coverage.drop("written_premium")


def fct_claim(stg_claim: DataFrame) -> DataFrame:
    return stg_claim.drop("coverage_code")


def fct_claim_transaction(stg_claim_transaction: DataFrame) -> DataFrame:
    return stg_claim_transaction


def fct_premium_transaction(stg_premium_transaction: DataFrame) -> DataFrame:
    return stg_premium_transaction.withColumnRenamed("cumulative_premium", "source_cumulative_premium")


def fct_exposure(
    earned_exposure_month: DataFrame,
    earned_premium_month: DataFrame,
    policy: DataFrame,
    risk_unit: DataFrame,
    coverage: DataFrame,
) -> DataFrame:
    """Earned exposure and premium per risk unit, coverage and month.

    Policy and risk unit attributes are attached to the coverage first, where
    there is one row per coverage; the monthly rows then meet them in a single
    join on ``coverage_id``, the key both monthly inputs are already hashed on.
    """
    holder = policy.select("policy_id", "product_id", "line_of_business")
    unit = risk_unit.select("risk_unit_id", "risk_unit_type", "exposure_unit")
    described = (
        coverage.select("coverage_id", "policy_id", "risk_unit_id", "coverage_code", "coverage_family")
        .join(holder, "policy_id")
        .join(unit, "risk_unit_id")
        .drop("policy_id", "risk_unit_id")
    )
    premium = earned_premium_month.select("coverage_id", "calendar_month", "earned_premium")
    return (
        earned_exposure_month.join(premium, ["coverage_id", "calendar_month"], "left")
        .join(described, "coverage_id")
        .select(
            surrogate_key("risk_unit_id", "coverage_id", "calendar_month").alias("exposure_id"),
            "policy_id",
            "risk_unit_id",
            "coverage_id",
            "calendar_month",
            "product_id",
            "line_of_business",
            "risk_unit_type",
            "exposure_unit",
            "coverage_code",
            "coverage_family",
            "earned_exposure",
            F.coalesce("earned_premium", F.lit(0).cast("decimal(18,6)")).alias("earned_premium"),
        )
    )
