"""Data-quality checks. Each returns the failing rows; an empty result passes."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.functions import dates as D
from ratewright.functions.money import prorate_micros, to_cents
from ratewright.functions.segments import SEGMENT, segment_columns
from ratewright.operators.controls import full_outer, one_row_of
from ratewright.operators.exposure import DAYS_PER_YEAR
from ratewright.operators.ldf import MEASURES, development_pairs
from ratewright.operators.ultimate import YEAR_KEYS, latest_diagonal

ERROR, WARN = "error", "warn"
_CELL = [*SEGMENT, "development"]

# ---- generic checks -------------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(~F.col(column).isin(values))


def relationships(child: DataFrame, column: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child key values without a parent, with the number of child rows.

    Children collapse to distinct keys before the join, so a key that many
    children share costs one row.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return keys.join(parent.select(F.col(field_).alias("key")), "key", "left_anti")


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false; NULL passes."""
    return df.where(~F.expr(expression))


def out_of_range(c: Column, low: float | None, high: float | None, inclusive: bool = True) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | ((c < low) if inclusive else (c <= low))
    if high is not None:
        bad = bad | ((c > high) if inclusive else (c >= high))
    return bad


def accepted_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None, inclusive: bool = True
) -> DataFrame:
    return df.where(out_of_range(F.col(column), low, high, inclusive))


def effective_date_valid(df: DataFrame, column: str, today: date, min_date: date = date(2010, 1, 1)) -> DataFrame:
    c = F.col(column)
    return df.where(c.isNull() | (c < D.day(min_date)) | (c > D.day(today)))


# ---- whole-contract reports: one row per rule -----------------------------------


@dataclass(frozen=True)
class TableContract:
    """What a table promises. ``key`` is empty where no single column is unique."""

    key: str
    required: list[str]
    accepted: dict[str, list] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    expressions: dict[str, str] = field(default_factory=dict)
    unique_keys: list[str] = field(default_factory=list)
    combinations: list[list[str]] = field(default_factory=list)
    ranges: dict[str, tuple[float | None, float | None, bool]] = field(default_factory=dict)  # low, high, inclusive
    lies_by: str = ""  # a column that the rows are hashed on where they are computed


_STATES = ["CA", "TX", "FL", "NY", "IL", "PA", "OH", "GA", "NC", "MI"]
_TERM = {"term_is_positive": "expiration_date > effective_date"}
_POLICY = {"policy_id": ("raw_policy", "policy_id")}

# The source contract.
CONTRACT = {
    "raw_policy": TableContract(
        "policy_id",
        "policy_id policy_number insured_id product_id line_of_business effective_date expiration_date status "
        "underwriting_tier primary_state term_months source_system load_batch_id ingested_at".split(),
        {
            "line_of_business": ["personal_auto", "commercial_property"],
            "status": ["active", "cancelled", "expired"],
            "underwriting_tier": ["preferred", "standard", "nonstandard", "high_risk"],
            "primary_state": _STATES,
            "term_months": [6, 12],
            "source_system": ["policy_admin_auto_sim", "policy_admin_property_sim"],
        },
        {},
        {
            **_TERM,
            "cancellation_in_term": "cancellation_date is null or "
            "(cancellation_date >= effective_date and cancellation_date <= expiration_date)",
        },
        ["policy_number"],
    ),
    "raw_policy_risk_unit": TableContract(
        "risk_unit_id",
        "risk_unit_id policy_id risk_unit_type source_risk_unit_id effective_date expiration_date status "
        "exposure_unit source_system load_batch_id ingested_at".split(),
        {"risk_unit_type": ["vehicle", "property_location"], "exposure_unit": ["car_year", "location_year"]},
        _POLICY,
        _TERM,
    ),
    "raw_policy_coverage": TableContract(
        "coverage_id",
        "coverage_id policy_id risk_unit_id coverage_code coverage_family effective_date expiration_date "
        "limit_amount deductible_amount written_premium source_system load_batch_id ingested_at".split(),
        {},
        {**_POLICY, "risk_unit_id": ("raw_policy_risk_unit", "risk_unit_id")},
        _TERM,
    ),
    "raw_premium_transaction": TableContract(
        "transaction_id",
        "transaction_id policy_id coverage_id transaction_type transaction_date transaction_reason "
        "premium_change cumulative_premium source_system load_batch_id ingested_at".split(),
        {"transaction_type": ["NEW_BUSINESS", "ENDORSEMENT", "CANCELLATION"]},
        {**_POLICY, "coverage_id": ("raw_policy_coverage", "coverage_id")},
        {"balance_not_negative": "cumulative_premium >= 0"},
    ),
    "raw_claim": TableContract(
        "claim_id",
        "claim_id policy_id risk_unit_id coverage_id coverage_code loss_date reported_date claim_status "
        "source_system load_batch_id ingested_at".split(),
        {
            "claim_type": [
                "collision", "weather", "theft", "bodily_injury", "property_damage", "fire", "wind_hail", "water",
            ],
            "cause_code": ["at_fault", "weather", "theft", "fire", "water"],
            "claim_status": ["open", "closed"],
        },
        {
            **_POLICY,
            "risk_unit_id": ("raw_policy_risk_unit", "risk_unit_id"),
            "coverage_id": ("raw_policy_coverage", "coverage_id"),
        },
        {"reported_after_loss": "reported_date >= loss_date"},
    ),
    "raw_claim_transaction": TableContract(
        "transaction_id",
        "transaction_id claim_id transaction_type transaction_date paid_loss_change case_reserve_change "
        "paid_expense_change case_expense_change recovery_change incurred_loss_change source_system "
        "load_batch_id ingested_at".split(),
        {"transaction_type": ["RESERVE_SET", "PAYMENT"]},
        {"claim_id": ("raw_claim", "claim_id")},
        {
            "incurred_is_sum_of_parts": "abs(incurred_loss_change - (paid_loss_change + case_reserve_change "
            "+ paid_expense_change + case_expense_change - recovery_change)) <= 0.01",
            "paid_not_negative": "paid_loss_change >= 0",
            "paid_expense_not_negative": "paid_expense_change >= 0",
            "recovery_not_negative": "recovery_change >= 0",
        },
    ),
    "raw_vehicle": TableContract(
        "vehicle_id",
        "vehicle_id policy_id vehicle_sequence model_year make model vehicle_type garaging_state annual_mileage "
        "usage safety_device_flag source_system load_batch_id ingested_at".split(),
        {
            "vehicle_type": ["sedan", "suv", "truck", "sports"],
            "usage": ["commute", "pleasure", "business"],
            "safety_device_flag": [0, 1],
        },
        _POLICY,
        {"sequence_positive": "vehicle_sequence > 0", "mileage_positive": "annual_mileage > 0"},
    ),
    "raw_driver": TableContract(
        "driver_id",
        "driver_id policy_id driver_sequence date_of_birth gender years_licensed prior_accidents "
        "prior_violations marital_status credit_tier source_system load_batch_id ingested_at".split(),
        {
            "gender": ["F", "M", "X"],
            "marital_status": ["single", "married", "divorced"],
            "credit_tier": ["A", "B", "C", "D"],
        },
        _POLICY,
        {
            "sequence_positive": "driver_sequence > 0",
            "years_licensed_not_negative": "years_licensed >= 0",
            "accidents_not_negative": "prior_accidents >= 0",
            "violations_not_negative": "prior_violations >= 0",
        },
    ),
    "raw_driver_vehicle_assignment": TableContract(
        "assignment_id",
        "assignment_id policy_id driver_id vehicle_id assignment_type effective_date expiration_date "
        "source_system load_batch_id ingested_at".split(),
        {"assignment_type": ["PRIMARY", "OCCASIONAL"]},
        {
            **_POLICY,
            "driver_id": ("raw_driver", "driver_id"),
            "vehicle_id": ("raw_vehicle", "vehicle_id"),
        },
        _TERM,
    ),
    "raw_property_location": TableContract(
        "location_id",
        "location_id policy_id location_sequence state zip_code occupancy construction_type year_built "
        "protection_class total_insured_value source_system load_batch_id ingested_at".split(),
        {
            "state": _STATES,
            "occupancy": ["office", "retail", "warehouse", "manufacturing"],
            "construction_type": ["frame", "masonry", "noncombustible", "fire_resistive"],
        },
        _POLICY,
        {
            "sequence_positive": "location_sequence > 0",
            "protection_class_in_range": "protection_class between 1 and 10",
            "insured_value_positive": "total_insured_value > 0",
        },
    ),
}

# Key combinations that must be unique.
UNIQUE_COMBINATIONS = {
    "raw_vehicle": ["policy_id", "vehicle_sequence"],
    "raw_driver": ["policy_id", "driver_sequence"],
    "raw_driver_vehicle_assignment": ["policy_id", "driver_id", "vehicle_id", "effective_date"],
    "raw_property_location": ["policy_id", "location_sequence"],
}


def _counted(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Failing rows of many row-level rules in one scan of the table."""
    counts = df.agg(*[F.count(F.when(bad, 1)).alias(f"c{i}") for i, bad in enumerate(rules.values())])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"c{i}").alias("failing_rows"))
            for i, name in enumerate(rules)
        ]
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline(rows))


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def not_null_report(tables: dict[str, DataFrame], contract: dict[str, TableContract] = CONTRACT) -> DataFrame:
    return _stack(
        [_counted(tables[t], t, {c: F.col(c).isNull() for c in k.required}) for t, k in contract.items()]
    )


def accepted_values_report(tables: dict[str, DataFrame], contract: dict[str, TableContract] = CONTRACT) -> DataFrame:
    return _stack(
        [
            _counted(tables[t], t, {c: ~F.col(c).isin(v) for c, v in k.accepted.items()})
            for t, k in contract.items()
            if k.accepted
        ]
    )


def expression_report(tables: dict[str, DataFrame], contract: dict[str, TableContract] = CONTRACT) -> DataFrame:
    return _stack(
        [
            _counted(tables[t], t, {name: ~F.expr(e) for name, e in k.expressions.items()})
            for t, k in contract.items()
            if k.expressions
        ]
    )


def count_failures(df: DataFrame, table: str, rule: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "failing_rows"
    )


# ---- claims ---------------------------------------------------------------------


def not_month_end(df: DataFrame, column: str) -> DataFrame:
    """Rows whose date is no month end; a valuation date must be one."""
    return df.where(F.col(column) != F.last_day(column))


def claim_cumulative_incurred_reconciles(cumulative: DataFrame) -> DataFrame:
    reported, parts = F.col("cumulative_incurred_loss"), F.col("calculated_cumulative_incurred")
    return cumulative.where(reported.isNull() | parts.isNull() | (F.abs(parts - reported) > 0.01)).select(
        "claim_id",
        "event_date",
        "cumulative_incurred_loss",
        "calculated_cumulative_incurred",
        (parts - reported).alias("incurred_difference"),
    )


def state_period_faults(periods: DataFrame) -> DataFrame:
    """State periods of a claim that overlap, leave a gap, are empty or occur twice.

    Without such a row every day from a claim's first period on lies in exactly one
    period, so (claim, valuation date) is unique and complete for any calendar; the
    valuations themselves need not be listed. Periods meet their neighbours in order:
    the window holds one row for each distinct period, however often it occurs.
    """
    distinct = periods.groupBy("claim_id", "valid_from_date", "valid_to_date").agg(F.count(F.lit(1)).alias("row_count"))
    earlier = (
        Window.partitionBy("claim_id")
        .orderBy("valid_from_date", "valid_to_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    begins, ends, before = F.col("valid_from_date"), F.col("valid_to_date"), F.col("covered_to_date")
    fault = (
        F.when(begins.isNull() | ends.isNull() | (ends <= begins), "empty")
        .when(F.col("row_count") > 1, "repeated")
        .when(begins < before, "overlap")
        .when(begins > before, "gap")
    )
    return (
        distinct.withColumn("covered_to_date", F.max("valid_to_date").over(earlier))
        .withColumn("fault", fault)
        .where("fault IS NOT NULL")
        .select("claim_id", "valid_from_date", "valid_to_date", "covered_to_date", "row_count", "fault")
    )


def claim_snapshot_population(claims: DataFrame, valuation_dates: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Valuation dates whose snapshot does not hold every claim reported by then.

    Expected counts are running totals of claims per report month; no claim is
    paired with the dates that follow it.
    """
    months = valuation_dates.select("valuation_date", "valuation_month")
    first = months.agg(F.min("valuation_month")).scalar()
    entered = (
        claims.where(F.col("reported_date").isNotNull())
        .groupBy(D.month_start(F.col("reported_date")).alias("report_month"))
        .agg(F.count_distinct("claim_id").alias("claims"))
        .groupBy(F.greatest(F.col("report_month"), first).alias("valuation_month"))
        .agg(F.sum("claims").alias("claims"))
    )
    # one row per calendar month
    running = Window.orderBy("valuation_date").rowsBetween(Window.unboundedPreceding, 0)
    expected = (
        months.join(entered, "valuation_month", "left")
        .select("valuation_date", F.sum(F.coalesce("claims", F.lit(0))).over(running).alias("expected_claim_count"))
        .where("expected_claim_count > 0")
    )
    # the snapshot holds one row per claim and date
    actual = snapshot.groupBy("valuation_date").agg(F.count("claim_id").alias("actual_claim_count"))
    return expected.join(actual, "valuation_date", "left").where(
        F.col("expected_claim_count") != F.coalesce("actual_claim_count", F.lit(0))
    )


# ---- exposure -------------------------------------------------------------------


def coverage_parent_bounds(
    coverage: DataFrame, policy: DataFrame, risk_unit: DataFrame, active_period: DataFrame
) -> DataFrame:
    """Active periods that reach outside their policy or risk unit."""
    holder = policy.select(
        "policy_id",
        "cancellation_date",
        F.col("effective_date").alias("p_effective"),
        F.col("expiration_date").alias("p_expiration"),
    )
    unit = risk_unit.select(
        "policy_id",
        "risk_unit_id",
        F.col("effective_date").alias("r_effective"),
        F.col("expiration_date").alias("r_expiration"),
    )
    expected = (
        coverage.join(holder, "policy_id")
        .join(unit, ["policy_id", "risk_unit_id"])
        .select(
            "coverage_id",
            F.greatest("effective_date", "p_effective", "r_effective").alias("expected_effective_date"),
            F.col("expiration_date").alias("expected_scheduled_expiration_date"),
            F.least(
                F.col("expiration_date"), D.actual_end(F.col("p_expiration"), F.col("cancellation_date")),
                F.col("r_expiration"),
            ).alias("expected_actual_expiration_date"),
        )
        .where("expected_actual_expiration_date > expected_effective_date")
    )
    actual = active_period.select(
        "coverage_id",
        "coverage_effective_date",
        "scheduled_expiration_date",
        "actual_expiration_date",
        F.lit(True).alias("found"),
    )
    differs = (
        F.col("found").isNull()
        | (F.col("coverage_effective_date") != F.col("expected_effective_date"))
        | (F.col("scheduled_expiration_date") != F.col("expected_scheduled_expiration_date"))
        | (F.col("actual_expiration_date") != F.col("expected_actual_expiration_date"))
    )
    return expected.join(actual, "coverage_id", "left").where(differs).drop("found")


def coverage_month_reconciles(coverage_months: DataFrame, active_period: DataFrame) -> DataFrame:
    monthly = coverage_months.groupBy("coverage_id").agg(F.sum("active_days").alias("monthly_active_days"))
    days = F.datediff("actual_expiration_date", "coverage_effective_date")
    return (
        active_period.select("coverage_id", days.alias("expected_active_days"))
        .join(monthly, "coverage_id", "left")
        .select(
            "coverage_id",
            "expected_active_days",
            F.coalesce("monthly_active_days", F.lit(0)).alias("monthly_active_days"),
        )
        .where("expected_active_days <> monthly_active_days")
    )


def earned_exposure_reconciles(earned_exposure: DataFrame, coverage_months: DataFrame) -> DataFrame:
    keys = ["policy_id", "risk_unit_id", "coverage_id"]
    earned = earned_exposure.groupBy(*keys).agg(F.sum("earned_exposure").alias("earned_exposure"))
    days = coverage_months.groupBy(*keys).agg(
        (F.sum("active_days") / F.lit(DAYS_PER_YEAR)).alias("expected_exposure")
    )
    return earned.join(days, keys).where(F.abs(F.col("earned_exposure") - F.col("expected_exposure")) > 0.00001)


def _premium_gap(expected: DataFrame, actual: DataFrame, name: str, got: str, tolerance: float) -> DataFrame:
    zero = F.lit(0)
    return (
        full_outer(expected, actual, ["coverage_id"])
        .select("coverage_id", F.coalesce(name, zero).alias(name), F.coalesce(got, zero).alias(got))
        .where(F.abs(F.col(name) - F.col(got)) > tolerance)
    )


def _earned_total(earned_premium: DataFrame, name: str) -> DataFrame:
    return earned_premium.groupBy("coverage_id").agg(F.sum("earned_premium").alias(name))


def earned_premium_reconciles_to_segments(segments: DataFrame, earned_premium: DataFrame) -> DataFrame:
    share = prorate_micros(
        to_cents(F.col("premium_change")),
        F.col("earning_days"),
        F.datediff("earning_end_date", "earning_start_date"),
    )
    expected = segments.groupBy("coverage_id").agg(
        (F.sum(share) * F.lit(0.000001)).alias("expected_earned_premium")
    )
    return _premium_gap(
        expected,
        _earned_total(earned_premium, "actual_earned_premium"),
        "expected_earned_premium",
        "actual_earned_premium",
        0.01,
    )


def earned_premium_reconciles_to_net_written(premium_transaction: DataFrame, earned_premium: DataFrame) -> DataFrame:
    written = premium_transaction.groupBy("coverage_id").agg(F.sum("premium_change").alias("net_written_premium"))
    return _premium_gap(
        written, _earned_total(earned_premium, "earned_premium"), "net_written_premium", "earned_premium", 0.02
    )


def _written_totals(policies: DataFrame) -> DataFrame:
    return policies.agg(
        F.sum("written_premium").cast("double").alias("written_premium"),
        (F.sum("term_months") / F.lit(12.0)).alias("written_exposure"),
    )


def _earned_totals(exposure: DataFrame) -> DataFrame:
    return exposure.agg(
        F.sum("total_earned_premium").cast("double").alias("earned_premium"),
        F.sum("total_earned_exposure").cast("double").alias("earned_exposure"),
    )


def _totals_of(left: DataFrame, right: DataFrame) -> DataFrame:
    """The columns of two one-row frames in one row."""
    return one_row_of(left=left, right=right).select("left.*", "right.*")


def policy_exposure_within_policy_totals(policies: DataFrame, exposure: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    totals = _totals_of(_written_totals(policies), _earned_totals(exposure))
    return totals.where(
        (F.coalesce("written_premium", zero) < F.coalesce("earned_premium", zero))
        | (F.coalesce("written_exposure", zero) < F.coalesce("earned_exposure", zero))
    ).select(
        F.col("written_premium").alias("expected_written_premium"),
        F.col("earned_premium").alias("actual_earned_premium"),
        F.col("written_exposure").alias("expected_exposure"),
        F.col("earned_exposure").alias("actual_earned_exposure"),
    )


def policy_exposure_aggregation_consistent(exposure: DataFrame) -> DataFrame:
    by_year = exposure.groupBy("calendar_year").agg(
        F.sum("total_earned_exposure").alias("total_earned_exposure"),
        F.sum("total_earned_premium").alias("total_earned_premium"),
    )
    overall = _earned_totals(exposure).withColumnsRenamed(
        {"earned_exposure": "overall_exposure", "earned_premium": "overall_earned_premium"}
    )
    again = _earned_totals(by_year).withColumnsRenamed(
        {"earned_exposure": "reaggregated_exposure", "earned_premium": "reaggregated_earned_premium"}
    )
    gap = lambda a, b: F.abs(F.col(a) - F.col(b)) > 0.000001
    return _totals_of(overall, again).where(
        gap("overall_exposure", "reaggregated_exposure")
        | gap("overall_earned_premium", "reaggregated_earned_premium")
    )


def earned_premium_within_written(policies: DataFrame, exposure: DataFrame) -> DataFrame:
    totals = _totals_of(_earned_totals(exposure), _written_totals(policies))
    return totals.where("earned_premium > written_premium").select("earned_premium", "written_premium")


def policy_exposure_not_negative(exposure: DataFrame) -> DataFrame:
    return exposure.where("total_earned_exposure < 0 or total_earned_premium < 0")


# ---- pricing triangle -----------------------------------------------------------


def claim_snapshot_reconciles(events: DataFrame, valuation_dates: DataFrame, snapshot: DataFrame, as_of: date) -> DataFrame:
    """Snapshot totals per valuation date against totals rebuilt from the events.

    The position of all claims at a date is the sum of all movements up to it,
    so expected totals are running sums of monthly movements.
    """
    months = valuation_dates.select("valuation_date", "valuation_month")
    first = months.agg(F.min("valuation_month")).scalar()
    seen = events.where(F.col("event_date") <= D.day(as_of))
    by_month = seen.groupBy(D.month_start(F.col("event_date")).alias("event_month")).agg(
        F.sum(to_cents(F.col("paid_loss_change"))).alias("paid"),
        F.sum(to_cents(F.col("incurred_loss_change"))).alias("incurred"),
    )
    starts = (
        seen.groupBy("claim_id")
        .agg(D.month_start(F.min("event_date")).alias("event_month"))
        .groupBy("event_month")
        .agg(F.count(F.lit(1)).alias("claims"))
    )
    moved = (
        full_outer(by_month, starts, ["event_month"])
        .groupBy(F.greatest(F.col("event_month"), first).alias("valuation_month"))
        .agg(*[F.sum(c).alias(c) for c in ("paid", "incurred", "claims")])
    )
    # one row per calendar month; every month counts, also those not valued
    running = Window.orderBy("valuation_month").rowsBetween(Window.unboundedPreceding, 0)
    totals = full_outer(moved, months, ["valuation_month"]).select(
        "valuation_date",
        *[F.sum(F.coalesce(c, F.lit(0))).over(running).alias(c) for c in ("paid", "incurred", "claims")],
    )
    expected = totals.where("valuation_date is not null and claims > 0").select(
        "valuation_date",
        (F.col("paid") / 100).alias("expected_cumulative_paid"),
        (F.col("incurred") / 100).alias("expected_incurred"),
        F.col("claims").alias("expected_claim_count"),
    )
    actual = snapshot.groupBy("valuation_date").agg(
        F.sum("cumulative_paid").cast("double").alias("actual_cumulative_paid"),
        F.sum("incurred").cast("double").alias("actual_incurred"),
        F.count("claim_id").alias("actual_claim_count"),
    )
    zero = F.lit(0.0)
    return full_outer(expected, actual, ["valuation_date"]).where(
        (F.abs(F.coalesce("expected_cumulative_paid", zero) - F.coalesce("actual_cumulative_paid", zero)) > 0.000001)
        | (F.abs(F.coalesce("expected_incurred", zero) - F.coalesce("actual_incurred", zero)) > 0.000001)
        | (F.coalesce("expected_claim_count", F.lit(0)) != F.coalesce("actual_claim_count", F.lit(0)))
    )


def triangle_reconciles_to_snapshot(
    snapshot: DataFrame, policies: DataFrame, triangle: DataFrame, version: str = "v3"
) -> DataFrame:
    keys = [*YEAR_KEYS, "development", "age_months", "valuation_date"]
    owner = policies.select("policy_id", "state", "risk_class", "vehicle_segment")
    started = F.make_date(F.year("accident_date"), F.lit(1), F.lit(1))
    age = (D.month_boundaries(started, F.col("valuation_date")) + 1).cast("int")
    expected = (
        snapshot.join(owner, "policy_id", "left")
        .groupBy(
            *segment_columns(version),
            F.year("accident_date").alias("accident_year"),
            F.floor((age - 1) / 12).cast("int").alias("development"),
            age.alias("age_months"),
            "valuation_date",
        )
        .agg(
            F.sum("cumulative_paid").alias("expected_cumulative_paid"),
            F.sum("incurred").alias("expected_cumulative_incurred"),
            F.count("claim_id").alias("expected_claim_count"),
        )
    )
    actual = triangle.select(
        *keys,
        F.col("cumulative_paid").alias("actual_cumulative_paid"),
        F.col("cumulative_incurred").alias("actual_cumulative_incurred"),
        F.col("cumulative_claim_count").alias("actual_claim_count"),
    )
    zero = F.lit(0)
    differs = [
        F.abs(F.coalesce(f"expected_{m}", zero) - F.coalesce(f"actual_{m}", zero)) > 0.000001
        for m in ("cumulative_paid", "cumulative_incurred", "claim_count")
    ]
    return full_outer(expected, actual, keys).where(differs[0] | differs[1] | differs[2])


def _decreasing(triangle: DataFrame, column: str, share: float) -> DataFrame:
    before = F.lag(column).over(Window.partitionBy(*YEAR_KEYS).orderBy("development"))
    name = f"prev_{column}"
    return triangle.withColumn(name, before).where(
        F.col(name).isNotNull() & (F.col(column).cast("double") < F.col(name).cast("double") * share)
    )


def triangle_paid_not_decreasing(triangle: DataFrame) -> DataFrame:
    return _decreasing(triangle, "cumulative_paid", 1.0)


def triangle_incurred_not_collapsing(triangle: DataFrame) -> DataFrame:
    return _decreasing(triangle, "cumulative_incurred", 0.9)


# ---- factors --------------------------------------------------------------------


def link_ratio_share_at_least_one(raw: DataFrame, column: str, share: float) -> DataFrame:
    """Summary row when too few link ratios reach 1."""
    counts = raw.where(F.col(column).isNotNull()).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col(column) >= 1, 1).otherwise(0)), F.lit(0)).alias("valid_rows"),
    )
    return counts.where((F.col("total_rows") > 0) & (F.col("valid_rows") < share * F.col("total_rows")))


def last3_defaults_to_one(triangle: DataFrame, last3: DataFrame) -> DataFrame:
    pairs = development_pairs(triangle).groupBy(*_CELL).agg(F.count(F.lit(1)).alias("ay_count"))
    off = [F.abs(F.col(f"last3_ldf_{s}") - 1) > 0.000001 for _, s in MEASURES.values()]
    return (
        last3.join(pairs, _CELL, "left")
        .where((F.coalesce("ay_count", F.lit(0)) < 3) & (off[0] | off[1] | off[2]))
        .drop("ay_count")
    )


def selected_ldf_coverage(raw: DataFrame, selected: DataFrame, measure: str) -> DataFrame:
    """Developments with an observed link ratio but no selected factor."""
    observed = raw.where(F.col(f"link_ratio_{MEASURES[measure][1]}").isNotNull())
    return observed.select(*_CELL).distinct().join(selected, _CELL, "left_anti")


def ldf_not_positive(selected: DataFrame, measure: str) -> DataFrame:
    """Selected factors that have no logarithm and would vanish from a CDF."""
    return selected.where(F.col(f"selected_ldf_{MEASURES[measure][1]}") <= 0)


def cdf_below_one(cdf: DataFrame) -> DataFrame:
    return cdf.where("cdf < 1")


def cdf_rising(cdf: DataFrame) -> DataFrame:
    before = F.lag("cdf").over(Window.partitionBy(*SEGMENT).orderBy("development"))
    return cdf.withColumn("prev_cdf", before).where("prev_cdf is not null and cdf > prev_cdf")


# ---- ultimates ------------------------------------------------------------------


def ultimate_equals_latest_at_unit_cdf(
    ultimate: DataFrame, triangle: DataFrame, by_month: DataFrame, measure: str
) -> DataFrame:
    column = MEASURES[measure][0]
    value = "ultimate_claim_count" if measure == "claim_count" else "ultimate_loss"
    latest = latest_diagonal(triangle, column, "age_months")
    joined = ultimate.join(latest, YEAR_KEYS).join(by_month, [*SEGMENT, "age_months"], "left")
    gap = F.abs(F.col(value) - F.col(column).cast("double"))
    return joined.where((F.coalesce("cdf", F.lit(1.0)) == 1) & (gap > 0.000001)).select(
        *YEAR_KEYS, value, column, "cdf"
    )


def ultimate_below_latest(ultimate: DataFrame, triangle: DataFrame, value: str, column: str) -> DataFrame:
    joined = ultimate.join(latest_diagonal(triangle, column).drop("development"), YEAR_KEYS)
    return joined.where(F.col(value) < F.col(column).cast("double"))


def selection_missing(candidates: DataFrame, selection: DataFrame) -> DataFrame:
    """Accident years with a candidate but no selected method."""
    return candidates.select(*YEAR_KEYS).distinct().join(selection, YEAR_KEYS, "left_anti")


# ---- report ---------------------------------------------------------------------


def quality_report(checks: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """One row per check: severity, failing rows and PASS, WARN or FAIL.

    Checks run one after the other; one count of each reaches the driver.
    """
    counts = [(name, severity, df.count()) for name, (severity, df) in checks.items()]
    spark = next(iter(checks.values()))[1].sparkSession
    rows = spark.createDataFrame(counts, "check_name string, severity string, failing_rows bigint")
    status = (
        F.when(F.col("failing_rows") == 0, "PASS").when(F.col("severity") == WARN, "WARN").otherwise("FAIL")
    )
    return rows.withColumn("status", status)
