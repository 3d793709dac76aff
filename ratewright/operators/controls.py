"""Reconciliation controls between source and derived totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewright.functions.money import ratio
from ratewright.functions.segments import SEGMENT, segment_columns
from ratewright.operators.ultimate import YEAR_KEYS

# Metric, absolute tolerance, percentage tolerance.
TOLERANCES = [
    ("written_premium_to_earned_premium_total", 0.01, 0.000001),
    ("written_exposure_to_earned_exposure_total", 0.000001, 0.000001),
    ("latest_cumulative_paid_total", 0.01, 0.000001),
    ("latest_cumulative_incurred_total", 0.01, 0.000001),
    ("latest_claim_count_total", 0.000001, 0.000001),
]
WARN_MULTIPLE = 5


def full_outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join that keeps one coalesced copy of the keys."""
    return left.join(right, keys, "full")


def side_by_side(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of tables that each have one row a key at most.

    The tables are stacked and each key's one value of a column picked, in one
    aggregation. Keys that a segmentation makes constant leave a join nothing to
    match on; they group like any other.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in keys])


def at_latest_valuation(df: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Rows of ``df`` at the latest valuation date of the snapshot."""
    return df.where(F.col("valuation_date") == snapshot.agg(F.max("valuation_date")).scalar())


def one_row_of(**totals: DataFrame) -> DataFrame:
    """One row with a struct per one-row input, each a scalar subquery."""
    spark = next(iter(totals.values())).sparkSession
    return spark.range(1).select(
        *[df.select(F.struct(*df.columns)).scalar().alias(name) for name, df in totals.items()]
    )


def mart_control_totals_financial_summary(
    policies: DataFrame, policy_exposure: DataFrame, snapshot: DataFrame, triangle: DataFrame
) -> DataFrame:
    """Five totals, source against target, with absolute and relative difference."""
    written = policies.agg(
        F.sum("written_premium").cast("double").alias("premium"),
        (F.sum("term_months") / F.lit(12.0)).alias("exposure"),
    )
    earned = policy_exposure.agg(
        F.sum("total_earned_premium").cast("double").alias("premium"),
        F.sum("total_earned_exposure").cast("double").alias("exposure"),
    )
    # one row per claim and valuation date: rows at one date are distinct claims
    held = at_latest_valuation(snapshot, snapshot).agg(
        F.sum("cumulative_paid").cast("double").alias("paid"),
        F.sum("incurred").cast("double").alias("incurred"),
        F.count("claim_id").cast("double").alias("claims"),
    )
    cells = at_latest_valuation(triangle, snapshot).agg(
        F.sum("cumulative_paid").cast("double").alias("paid"),
        F.sum("cumulative_incurred").cast("double").alias("incurred"),
        F.sum("cumulative_claim_count").cast("double").alias("claims"),
    )
    pairs = [
        ("written.premium", "earned.premium"),
        ("written.exposure", "earned.exposure"),
        ("held.paid", "cells.paid"),
        ("held.incurred", "cells.incurred"),
        ("held.claims", "cells.claims"),
    ]
    metrics = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric_name"),
                F.col(source).alias("source_value"),
                F.col(target).alias("target_value"),
            )
            for (name, _, _), (source, target) in zip(TOLERANCES, pairs)
        ]
    )
    one_row = one_row_of(written=written, earned=earned, held=held, cells=cells)
    gap = F.col("target_value") - F.col("source_value")
    return one_row.select(F.inline(metrics)).select(
        "metric_name",
        "source_value",
        "target_value",
        gap.alias("absolute_difference"),
        ratio(gap, F.abs("source_value")).alias("percentage_difference"),
    )


def control_status(absolute: Column, percentage: Column, abs_tolerance: Column, pct_tolerance: Column) -> Column:
    within = (F.abs(absolute) <= abs_tolerance) & (F.abs(F.coalesce(percentage, F.lit(0.0))) <= pct_tolerance)
    near = F.abs(absolute) <= abs_tolerance * WARN_MULTIPLE
    return F.when(within, "PASS").when(near, "WARN").otherwise("FAIL")


def mart_control_tolerance_by_metric(totals: DataFrame) -> DataFrame:
    tolerances = totals.sparkSession.createDataFrame(
        TOLERANCES, "metric_name string, absolute_tolerance double, percentage_tolerance double"
    )
    status = control_status(
        F.col("absolute_difference"),
        F.col("percentage_difference"),
        F.col("absolute_tolerance"),
        F.col("percentage_tolerance"),
    )
    # five rows
    return totals.join(F.broadcast(tolerances), "metric_name", "left").withColumn("control_status", status)


def mart_reconciliation_by_segment(
    snapshot: DataFrame, policies: DataFrame, triangle: DataFrame, policy_exposure: DataFrame, version: str = "v3"
) -> DataFrame:
    owner = policies.select("policy_id", "state", "risk_class", "vehicle_segment")
    source = (
        at_latest_valuation(snapshot, snapshot)
        .join(owner, "policy_id", "left")
        .select(*segment_columns(version), "claim_id", "cumulative_paid", "incurred")
        .groupBy(*SEGMENT)
        .agg(
            F.sum("cumulative_paid").alias("source_cumulative_paid"),
            F.sum("incurred").alias("source_cumulative_incurred"),
            F.count("claim_id").alias("source_claim_count"),
        )
    )
    target = (
        at_latest_valuation(triangle, snapshot)
        .groupBy(*SEGMENT)
        .agg(
            F.sum("cumulative_paid").alias("target_cumulative_paid"),
            F.sum("cumulative_incurred").alias("target_cumulative_incurred"),
            F.sum("cumulative_claim_count").alias("target_claim_count"),
        )
    )
    exposure = policy_exposure.groupBy(*SEGMENT).agg(
        F.sum("total_earned_exposure").alias("total_earned_exposure"),
        F.sum("total_earned_premium").alias("total_earned_premium"),
    )
    joined = side_by_side([source, target, exposure], SEGMENT)

    def gap(what: str) -> Column:
        return F.col(f"target_{what}") - F.col(f"source_{what}")

    return joined.select(
        *SEGMENT,
        "source_cumulative_paid",
        "target_cumulative_paid",
        gap("cumulative_paid").alias("paid_difference"),
        "source_cumulative_incurred",
        "target_cumulative_incurred",
        gap("cumulative_incurred").alias("incurred_difference"),
        "source_claim_count",
        "target_claim_count",
        gap("claim_count").alias("claim_count_difference"),
        "total_earned_exposure",
        "total_earned_premium",
    )


def mart_assumption_impact_reconciliation(
    selected_loss: DataFrame,
    selected_count: DataFrame,
    loss_candidates: DataFrame,
    count_candidates: DataFrame,
    trend_selection: DataFrame,
    baseline_loss_method: str = "Chain_ladder",
    baseline_count_method: str = "Chain_ladder",
) -> DataFrame:
    """Selected against baseline ultimates, with the selected trends beside them."""
    losses = selected_loss.select(
        *YEAR_KEYS,
        F.col("method").alias("selected_loss_method"),
        F.col("ultimate_loss").alias("selected_ultimate_loss"),
    )
    counts = selected_count.select(
        *YEAR_KEYS,
        F.col("method").alias("selected_claim_count_method"),
        F.col("ultimate_claim_count").alias("selected_ultimate_claim_count"),
    )
    loss_base = loss_candidates.where(F.col("method") == baseline_loss_method).select(
        *YEAR_KEYS, F.col("ultimate_loss").alias("chain_ladder_ultimate_loss")
    )
    count_base = count_candidates.where(F.col("method") == baseline_count_method).select(
        *YEAR_KEYS, F.col("ultimate_claim_count").alias("chain_ladder_ultimate_claim_count")
    )

    def trend(kind: str) -> DataFrame:
        return trend_selection.where(F.col("trend_type") == kind).select(
            *SEGMENT, F.col("annual_trend").alias(f"selected_{kind}_trend")
        )

    joined = (
        full_outer(losses, counts, YEAR_KEYS)
        .join(loss_base, YEAR_KEYS, "left")
        .join(count_base, YEAR_KEYS, "left")
        .join(trend("frequency"), SEGMENT, "left")
        .join(trend("severity"), SEGMENT, "left")
    )
    loss_impact = F.col("selected_ultimate_loss") - F.col("chain_ladder_ultimate_loss")
    count_impact = F.col("selected_ultimate_claim_count") - F.col("chain_ladder_ultimate_claim_count")
    return joined.select(
        *YEAR_KEYS,
        "selected_loss_method",
        "selected_claim_count_method",
        "selected_ultimate_loss",
        "chain_ladder_ultimate_loss",
        loss_impact.alias("loss_method_impact"),
        "selected_ultimate_claim_count",
        "chain_ladder_ultimate_claim_count",
        count_impact.alias("claim_count_method_impact"),
        "selected_frequency_trend",
        "selected_severity_trend",
    )


def mart_reserve_pricing_movement_attribution(
    frequency_severity: DataFrame, trended: DataFrame, indicated: DataFrame, assumption_impact: DataFrame
) -> DataFrame:
    """How trend, loadings and reserve selections move the premium of a segment."""
    carried = trended.select(
        *YEAR_KEYS,
        "trended_frequency",
        "trended_severity",
        F.col("total_earned_exposure").alias("trended_exposure"),
    )
    base_cost = F.col("frequency") * F.col("severity") * F.col("total_earned_exposure")
    trended_cost = F.col("trended_frequency") * F.col("trended_severity") * F.col("trended_exposure")
    base = (
        frequency_severity.join(carried, YEAR_KEYS)
        .groupBy(*SEGMENT)
        .agg(
            F.sum("total_earned_exposure").alias("total_earned_exposure"),
            ratio(F.sum(base_cost), F.sum("total_earned_exposure")).alias("base_pure_premium"),
            ratio(F.sum(trended_cost), F.sum("trended_exposure")).alias("trended_pure_premium"),
        )
    )
    reserve = assumption_impact.groupBy(*SEGMENT).agg(
        F.sum("loss_method_impact").alias("reserve_loss_method_impact"),
        F.sum("claim_count_method_impact").alias("reserve_claim_count_method_impact"),
    )
    return (
        base.join(indicated.select(*SEGMENT, "indicated_premium"), SEGMENT, "left")
        .join(reserve, SEGMENT, "left")
        .select(
            *SEGMENT,
            "total_earned_exposure",
            "base_pure_premium",
            "trended_pure_premium",
            "indicated_premium",
            (F.col("trended_pure_premium") - F.col("base_pure_premium")).alias("trend_impact_on_pure_premium"),
            (F.col("indicated_premium") - F.col("trended_pure_premium")).alias("expense_and_profit_impact"),
            "reserve_loss_method_impact",
            "reserve_claim_count_method_impact",
        )
    )


def mart_incurred_coverage(raw: DataFrame, selected_incurred: DataFrame) -> DataFrame:
    """Which observed incurred developments have a selected factor, and the reverse."""
    cell = [*SEGMENT, "development"]
    required = raw.where(F.col("link_ratio_incurred").isNotNull()).select(*cell).distinct()
    selected = selected_incurred.select(*cell).distinct()
    joined = full_outer(
        required.withColumn("is_required", F.lit(True)), selected.withColumn("is_selected", F.lit(True)), cell
    )
    status = (
        F.when(F.col("is_required") & F.col("is_selected"), "matched")
        .when(F.col("is_required"), "missing_selected")
        .otherwise("extra_selected")
    )
    return joined.select(*cell, status.alias("status"))
