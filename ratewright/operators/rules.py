"""Deterministic insurance rules as column expressions and table steps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.functions import dates as D
from ratewright.functions.money import MONEY, div_floor, from_cents, to_cents
from ratewright.session import materialize

DAYS_PER_YEAR = 365.25

# Rating factors, base rates, trends and payment patterns.
AUTO_STATE = {
    "CA": 1.10, "TX": 1.00, "FL": 1.20, "NY": 1.25, "IL": 1.05,
    "PA": 0.95, "OH": 0.90, "GA": 1.00, "NC": 0.90, "MI": 1.30,
}
AUTO_VEHICLE = {"sedan": 1.00, "suv": 1.15, "truck": 1.20, "sports": 1.45}
AUTO_USAGE = {"commute": 1.05, "pleasure": 0.90, "business": 1.15}
AUTO_DEDUCTIBLE = {0: 1.00, 250: 0.95, 500: 0.90, 1000: 0.80, 2500: 0.65}
AUTO_LIMIT = {25000: 0.85, 50000: 1.00, 100000: 1.25, 250000: 1.60, 500000: 2.10}
AUTO_BASE_RATE = {"AUTO_BI": 420, "AUTO_PD": 180, "AUTO_COLL": 310, "AUTO_COMP": 170}
TIER = {"preferred": 0.85, "standard": 1.00, "nonstandard": 1.25, "high_risk": 1.70}
PROPERTY_STATE = {"FL": 1.10, "TX": 1.05, "GA": 1.03}
PROPERTY_OCCUPANCY = {"office": 0.90, "retail": 1.00, "warehouse": 1.10, "manufacturing": 1.25}
PROPERTY_CONSTRUCTION = {"frame": 1.15, "masonry": 1.00, "noncombustible": 0.90, "fire_resistive": 0.80}
PROPERTY_BASE_RATE = {"BUILDING": 0.0025, "BUSINESS_PERSONAL_PROPERTY": 0.0018}
AUTO_PREMIUM_TREND = 0.04
PROPERTY_PREMIUM_TREND = 0.035
# month after report, cumulative paid share, outstanding reserve share
PATTERNS = {
    "personal_auto": [(0, 0.00, 0.85), (1, 0.20, 0.65), (3, 0.50, 0.35), (6, 0.80, 0.20), (12, 1.00, 0.00)],
    "commercial_property": [(0, 0.00, 0.90), (3, 0.10, 0.85), (6, 0.30, 0.65), (12, 0.65, 0.35), (24, 1.00, 0.00)],
}


def factor(table: dict, key: Column, default: float | None = None) -> Column:
    """Factor of a level; ``default`` for a level the table lacks."""
    expr = F.when(F.lit(False), F.lit(None).cast("double"))
    for level, value in table.items():
        expr = expr.when(key == level, F.lit(float(value)))
    return expr.otherwise(F.lit(default).cast("double"))


def coverage_term_factor(effective: Column, expiration: Column) -> Column:
    """Share of a year covered; NULL for a term that does not end after it starts."""
    days = F.datediff(expiration, effective)
    return F.when(days > 0, days / F.lit(DAYS_PER_YEAR))


def invalid_terms(coverage: DataFrame) -> DataFrame:
    """Coverages whose term is empty or reversed."""
    return coverage.where(F.datediff("expiration_date", "effective_date") <= 0)


def risk_exposure_window(risk_unit: DataFrame, policy: DataFrame, study_end: date) -> DataFrame:
    """Start, end and years of exposure of each risk unit inside the study."""
    holder = policy.select(
        "policy_id", D.actual_end(F.col("expiration_date"), F.col("cancellation_date")).alias("policy_end")
    )
    end = F.least(F.col("policy_end"), F.col("expiration_date"), D.day(study_end))
    years = F.greatest(F.datediff(end, F.col("effective_date")) / F.lit(DAYS_PER_YEAR), F.lit(0.0))
    return risk_unit.join(holder, "policy_id").select(
        "risk_unit_id",
        "policy_id",
        F.col("effective_date").alias("exposure_start"),
        end.alias("exposure_end"),
        years.alias("exposure_years"),
    )


def trend_factor(on: Column, annual_trend: float, base_year: int | Column) -> Column:
    """(1 + trend) ** years since the base year, never below one year's zero."""
    base = F.lit(base_year) if isinstance(base_year, int) else base_year
    years = F.greatest(F.year(on) - base, F.lit(0))
    return F.pow(F.lit(1.0 + annual_trend), years.cast("double"))


def coverage_terms(ground_up: Column, deductible: Column, limit: Column) -> Column:
    """Loss above the deductible, up to the limit."""
    above = F.greatest(ground_up - deductible, F.lit(0).cast(MONEY))
    return F.round(F.least(above, limit), 2).cast(MONEY)


def claim_status(reported: Column, closure_months: Column | int, study_end: date) -> Column:
    closes = F.add_months(reported, closure_months)
    return F.when(closes <= D.day(study_end), "closed").otherwise("open")


def primary_driver(assignment: DataFrame) -> DataFrame:
    """One driver per vehicle: a PRIMARY one if assigned, else the first assigned.

    Of several PRIMARY assignments the last one counts. The two aggregates merge
    on the map side, so a vehicle with many assignments costs no window.
    """
    is_primary = F.col("assignment_type") == "PRIMARY"
    return (
        assignment.groupBy("vehicle_id")
        .agg(
            F.max_by(F.when(is_primary, F.col("driver_id")), F.when(is_primary, F.col("assignment_id"))).alias("primary"),
            F.min_by("driver_id", "assignment_id").alias("first"),
        )
        .select("vehicle_id", F.coalesce("primary", "first").alias("driver_id"))
    )


def auto_premium(
    coverage: DataFrame,
    policy: DataFrame,
    risk_unit: DataFrame,
    vehicle: DataFrame,
    assignment: DataFrame,
    driver: DataFrame,
    base_year: int | Column,
) -> DataFrame:
    """Rated premium of personal auto coverages."""
    holder = policy.where(F.col("line_of_business") == "personal_auto").select(
        "policy_id", "primary_state", "underwriting_tier", F.col("effective_date").alias("inception")
    )
    person = driver.select("driver_id", "date_of_birth", "prior_accidents")
    car = vehicle.select("vehicle_id", "vehicle_type", "usage")
    unit = risk_unit.where(F.col("risk_unit_type") == "vehicle").select(
        "risk_unit_id", F.col("source_risk_unit_id").alias("vehicle_id")
    )
    rated_unit = unit.join(car, "vehicle_id").join(
        primary_driver(assignment).join(person, "driver_id"), "vehicle_id"
    )
    age = D.completed_age(F.col("date_of_birth"), F.col("inception"))
    by_age = F.when(age < 25, 1.25).when(age >= 50, 0.90).otherwise(1.00)
    accidents = 1 + F.lit(0.08) * F.least(F.col("prior_accidents"), F.lit(5))
    pricing = (
        factor(AUTO_STATE, F.col("primary_state"), 1.00)
        * (by_age * accidents)
        * factor(AUTO_VEHICLE, F.col("vehicle_type"))
        * factor(AUTO_USAGE, F.col("usage"))
        * factor(AUTO_DEDUCTIBLE, F.col("deductible_amount"), 0.90)
        * factor(AUTO_LIMIT, F.col("limit_amount"), 1.00)
        * factor(TIER, F.col("underwriting_tier"))
        * trend_factor(F.col("inception"), AUTO_PREMIUM_TREND, base_year)
    )
    term = coverage_term_factor(F.col("effective_date"), F.col("expiration_date"))
    return (
        coverage.join(holder, "policy_id")
        .join(rated_unit, "risk_unit_id")
        .withColumn("pricing_factor", pricing)
        .select(
            "coverage_id",
            "coverage_code",
            "pricing_factor",
            F.round(factor(AUTO_BASE_RATE, F.col("coverage_code")) * F.col("pricing_factor") * term, 2).alias(
                "rated_premium"
            ),
        )
    )


def property_premium(
    coverage: DataFrame, policy: DataFrame, risk_unit: DataFrame, location: DataFrame, base_year: int | Column
) -> DataFrame:
    """Rated premium of commercial property coverages."""
    holder = policy.where(F.col("line_of_business") == "commercial_property").select(
        "policy_id", "underwriting_tier", F.col("effective_date").alias("inception")
    )
    site = location.select("location_id", "state", "occupancy", "construction_type")
    unit = risk_unit.where(F.col("risk_unit_type") == "property_location").select(
        "risk_unit_id", F.col("source_risk_unit_id").alias("location_id")
    )
    pricing = (
        factor(PROPERTY_OCCUPANCY, F.col("occupancy"))
        * factor(PROPERTY_CONSTRUCTION, F.col("construction_type"))
        * factor(PROPERTY_STATE, F.col("state"), 1.00)
        * factor(TIER, F.col("underwriting_tier"))
        * trend_factor(F.col("inception"), PROPERTY_PREMIUM_TREND, base_year)
    )
    term = coverage_term_factor(F.col("effective_date"), F.col("expiration_date"))
    amount = F.col("limit_amount").cast("double") * factor(PROPERTY_BASE_RATE, F.col("coverage_code"))
    return (
        coverage.join(holder, "policy_id")
        .join(unit.join(site, "location_id"), "risk_unit_id")
        .withColumn("pricing_factor", pricing)
        .select(
            "coverage_id",
            "coverage_code",
            "pricing_factor",
            F.round(amount * F.col("pricing_factor") * term, 2).alias("rated_premium"),
        )
    )


def cancellation_refund(premium_transaction: DataFrame, coverage: DataFrame, policy: DataFrame) -> DataFrame:
    """Unearned part of each cancelled coverage's earlier positive movements.

    The refund is a sum over movements, so those of one day are added before
    the join.
    """
    paid_in = (
        premium_transaction.where(F.col("transaction_type") != "CANCELLATION")
        .where(F.col("premium_change") > 0)
        .groupBy("coverage_id", "transaction_date")
        .agg(F.sum(to_cents(F.col("premium_change"))).alias("cents"))
    )
    cancelled = (
        coverage.select("coverage_id", "policy_id", "expiration_date")
        .join(
            policy.where(F.col("cancellation_date").isNotNull()).select("policy_id", "cancellation_date"), "policy_id"
        )
    )
    remaining = F.greatest(F.datediff("expiration_date", "cancellation_date"), F.lit(0)).cast("bigint")
    term = F.greatest(F.datediff("expiration_date", "transaction_date"), F.lit(1)).cast("bigint")
    # millionths keep the pro-rata shares exact enough to round once, at the end
    share = div_floor(F.col("cents") * remaining * 10_000, term)
    total = F.round(F.sum(share) / 10_000).cast("bigint")
    return (
        paid_in.join(cancelled, "coverage_id")
        .groupBy("coverage_id", "policy_id", "cancellation_date")
        .agg(from_cents(-total).alias("refund"))
    )


def running_premium_balance(premium_transaction: DataFrame) -> DataFrame:
    """Balance of each coverage after each movement; shown as zero when negative.

    Movements of one day run in order of transaction id. The sum runs on two levels.
    All movements are dealt in that order into slices of about equal size, so a coverage
    or a day with very many of them lies in several. Slice totals give the balance
    carried into each slice of a coverage's day: that window sees one row for a day and
    slice. The other window sees one slice. The slices are written once, because both
    levels must read the same ones.
    """
    change = to_cents(F.col("premium_change"))
    part = ["coverage_id", "transaction_date", "slice"]
    ordered = ["coverage_id", "transaction_date", "transaction_id"]
    dealt = premium_transaction.select(*ordered, "premium_change").repartitionByRange(*ordered)
    sliced = materialize(dealt.withColumn("slice", F.spark_partition_id()), "premium_slices")
    earlier = (
        Window.partitionBy("coverage_id")
        .orderBy("transaction_date", "slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    opening = (
        sliced.groupBy(*part)
        .agg(F.sum(change).alias("moved"))
        .select(*part, F.coalesce(F.sum("moved").over(earlier), F.lit(0)).alias("opening_cents"))
    )
    in_slice = Window.partitionBy(*part).orderBy("transaction_id").rowsBetween(Window.unboundedPreceding, 0)
    balance = F.col("opening_cents") + F.col("slice_cents")
    return (
        sliced.withColumn("slice_cents", F.sum(change).over(in_slice))
        .join(opening, part)
        .select(
            "transaction_id",
            "coverage_id",
            "transaction_date",
            "premium_change",
            from_cents(F.greatest(balance, F.lit(0))).alias("cumulative_premium"),
        )
    )


def develop_ultimates(
    claims: DataFrame,
    study_end: date,
    paid_expense_ratio: float = 0.10,
    case_expense_ratio: float = 0.08,
) -> DataFrame:
    """Expand each claim's ultimate into dated payment and reserve movements.

    ``claims`` has claim_id, line_of_business, reported_date, ultimate and
    recovery_ratio. Steps fall every 30-day month of the line's pattern;
    steps after ``study_end`` are not shown, and as they are the last ones of a
    claim the earlier movements do not depend on them.
    """
    money = lambda c: F.round(c, 2).cast(MONEY)
    ultimate = F.col("ultimate").cast(MONEY)

    def steps(pattern: list[tuple[int, float, float]]) -> Column:
        rows, paid_before, reserve_before = [], 0.0, 0.0
        for number, (month, paid, reserve) in enumerate(pattern):
            rows.append(
                F.struct(
                    F.lit(number).alias("step"),
                    F.date_add("reported_date", 30 * month).alias("transaction_date"),
                    F.lit(paid).cast("decimal(4,2)").alias("paid"),
                    F.lit(paid_before).cast("decimal(4,2)").alias("paid_before"),
                    F.lit(reserve).cast("decimal(4,2)").alias("reserve"),
                    F.lit(reserve_before).cast("decimal(4,2)").alias("reserve_before"),
                )
            )
            paid_before, reserve_before = paid, reserve
        return F.array(*rows)

    by_line = F.when(F.lit(False), F.lit(None))
    for line, pattern in PATTERNS.items():
        by_line = by_line.when(F.col("line_of_business") == line, steps(pattern))
    ratio = lambda r: F.lit(r).cast("decimal(6,4)")
    expense = lambda pct: money(money(ultimate * pct) * ratio(case_expense_ratio))
    moves = (
        claims.select("claim_id", "ultimate", F.col("recovery_ratio").cast("decimal(6,4)"), F.inline(
            F.filter(by_line, lambda s: s["transaction_date"] <= D.day(study_end))
        ))
        .withColumn("paid_loss_change", money(ultimate * F.col("paid")) - money(ultimate * F.col("paid_before")))
        .withColumn(
            "case_reserve_change", money(ultimate * F.col("reserve")) - money(ultimate * F.col("reserve_before"))
        )
        .withColumn("case_expense_change", expense(F.col("reserve")) - expense(F.col("reserve_before")))
        .withColumn("paid_expense_change", money(F.col("paid_loss_change") * ratio(paid_expense_ratio)))
        .withColumn("recovery_change", money(F.col("paid_loss_change") * F.col("recovery_ratio")))
    )
    incurred = (
        F.col("paid_loss_change")
        + F.col("case_reserve_change")
        + F.col("paid_expense_change")
        + F.col("case_expense_change")
        - F.col("recovery_change")
    )
    return moves.select(
        "claim_id",
        "step",
        F.when(F.col("step") == 0, "RESERVE_SET").otherwise("PAYMENT").alias("transaction_type"),
        "transaction_date",
        *[
            F.col(c).cast(MONEY).alias(c)
            for c in (
                "paid_loss_change",
                "case_reserve_change",
                "paid_expense_change",
                "case_expense_change",
                "recovery_change",
            )
        ],
        incurred.cast(MONEY).alias("incurred_loss_change"),
    )
