"""Every operator as a query over one directory of test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.functions.dates import actual_end
from ratewright.functions.segments import SEGMENT, all_versions
from ratewright.operators import (
    calendar,
    claims,
    contracts,
    core,
    exposure,
    features,
    governance,
    quality,
    review,
    rules,
    triangle,
)
from ratewright.operators.ldf import MEASURES
from ratewright.plans.book import Book
from ratewright.plans.perturb import FAULTS, Faulty, contested, perturbed
from ratewright.plans.present import present
from ratewright.session import scratch_path, size_to
from ratewright.sources import rest, schemas, staging, tables
from ratewright.sources.sample_source import resting_sample, sample_book, sample_shuffles, write_sample
from ratewright.sources.sample_tables import SAMPLE_PARAMS

QUERY_PARAMS = replace(SAMPLE_PARAMS, baseline_loss_method="Chain_ladder_incurred")
BASE_YEAR = 1995  # first policy year of the test book
CHECK_FROM = date(1996, 1, 1)
MAX_DEVELOPMENT = QUERY_PARAMS.as_of.year - 1995
Build = Callable[[Book], DataFrame]

_books: dict[tuple, Book] = {}


def book_for(spark: SparkSession, sf_dir: str, fresh: bool = False, **changes) -> Book:
    """The lineage of a directory, kept for the session.

    A kept book also keeps the tables it has written to the shared folder, as a
    pipeline would; ``fresh`` builds everything anew.
    """
    params = replace(QUERY_PARAMS, **changes)
    if fresh:
        return sample_book(spark, sf_dir, params)
    key = (spark.sparkContext.applicationId, sf_dir, params)
    if key not in _books:
        _books[key] = sample_book(spark, sf_dir, params)
    return _books[key]


# ---- sources and sinks --------------------------------------------------------


def _round_trip(b: Book, name: str, reader: Callable, fmt: str = "parquet") -> DataFrame:
    root = scratch_path(b.spark, "tables")
    df = rest.conformed(b.source(name), name)
    if fmt == "csv":
        tables.write_csv(df, f"{root}/{name}")
    else:
        tables.overwrite_table(df, f"{root}/{name}")
    return reader(b.spark, root, name, fmt)


def _overwrite_count(b: Book) -> DataFrame:
    path = scratch_path(b.spark, "raw_claim")
    written = tables.overwrite_table(b.source("raw_claim"), path)
    return b.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_read")).select(
        F.lit("raw_claim").alias("table_name"), F.lit(written).cast("bigint").alias("rows_written"), "rows_read"
    )


def _append(b: Book) -> DataFrame:
    path = scratch_path(b.spark, "raw_premium_transaction")
    moves = b.source("raw_premium_transaction")
    tables.append_table(moves.where("transaction_type = 'NEW_BUSINESS'"), path)
    tables.append_table(moves.where("transaction_type <> 'NEW_BUSINESS'"), path)
    return b.spark.read.schema(moves.schema).parquet(path).groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("premium_change").alias("premium_change")
    )


def _rerun_batches(b: Book) -> DataFrame:
    """Two batches, each loaded twice and the first once more in place; one load has died without its marker."""
    path = scratch_path(b.spark, "raw_premium_transaction")
    moves = b.source("raw_premium_transaction")
    first, second = moves.where("transaction_id % 2 = 0"), moves.where("transaction_id % 2 <> 0")
    tables.load_batch(first, path, "batch 1")
    tables.load_batch(second, path, "batch/2")
    tables.load_batch(second, path, "batch/2")
    tables.load_batch(first, path, "batch 1")
    tables.load_batch(first, path, "batch 1", replace=True)
    moves.drop("load_batch_id").write.parquet(f"{path}/load_batch_id=died")
    return tables.read_batches(b.spark, path, moves.schema).groupBy("load_batch_id", "transaction_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("premium_change").alias("premium_change")
    )


def _load_batches(b: Book) -> DataFrame:
    return b.source("raw_policy").groupBy("load_batch_id", "ingested_at").agg(F.count(F.lit(1)).alias("row_count"))


SOURCES: dict[str, Build] = {
    "read_raw_table": lambda b: _round_trip(b, "raw_claim", tables.read_raw),
    "read_assumption_table": lambda b: _round_trip(b, "ldf_selection_table", tables.read_assumption),
    "read_governance_table": lambda b: _round_trip(b, "assumption_version", tables.read_governance),
    "stamp_load_metadata": _load_batches,
    "overwrite_table": _overwrite_count,
    "append_table": _append,
    "csv_table": lambda b: _round_trip(b, "raw_policy_coverage", tables.read_raw, "csv"),
    "upper_case_headers": lambda b: tables.upper_case_headers(b.stg_driver),
    "load_batch_rerun": _rerun_batches,
    "concat_with_schema": lambda b: b.sample_raw.all_risk_units(),
}

# ---- staging -------------------------------------------------------------------

STAGING: dict[str, Build] = {
    name: (lambda b, n=name: getattr(b, n))
    for name in (
        "stg_policy stg_policy_risk_unit stg_policy_coverage stg_premium_transaction stg_claim "
        "stg_claim_transaction stg_vehicle stg_driver stg_driver_vehicle_assignment stg_property_location "
        "stg_ldf_selection_table stg_selected_ultimate_loss stg_selected_ultimate_claim_count "
        "stg_ultimate_selection_loss stg_ultimate_selection_claim_count stg_trend_selection "
        "stg_expense_assumption stg_rate_level_history"
    ).split()
}
STAGING["stg_assumption_version"] = lambda b: staging.stg_assumption_version(b.source("assumption_version"))
STAGING["stg_assumption_change_log"] = lambda b: staging.stg_assumption_change_log(_change_log(b))
STAGING["stg_pipeline_run_metadata"] = lambda b: staging.stg_pipeline_run_metadata(b.source("pipeline_run_metadata"))

# ---- calendar and parameters ------------------------------------------------------


def _bounds(b: Book) -> DataFrame:
    return calendar.calendar_bounds_of(b.stg_policy, "effective_date")


def _segment_policies(b: Book) -> DataFrame:
    versions = F.inline(all_versions(["state", "risk_class", "vehicle_segment"]))
    return b.priced_policy.select(versions).groupBy("segmentation_version", *SEGMENT).agg(
        F.count(F.lit(1)).alias("policies")
    )


CALENDAR: dict[str, Build] = {
    "dim_date": lambda b: calendar.dim_date(_bounds(b)),
    "dim_calendar_month": lambda b: calendar.dim_calendar_month(_bounds(b)),
    "valuation_dates": lambda b: b.valuation_dates,
    "generate_years": lambda b: calendar.generate_years(b.stg_policy, "effective_date"),
    "segmentation_grouping": _segment_policies,
    "actual_end_date": lambda b: b.stg_policy.select(
        "policy_id", actual_end(F.col("expiration_date"), F.col("cancellation_date")).alias("actual_end_date")
    ),
}

# ---- models ----------------------------------------------------------------------

MODELS: dict[str, Build] = {
    name: (lambda b, n=name: getattr(b, n))
    for name in (
        "dim_policy dim_risk_unit dim_coverage fct_claim fct_claim_transaction fct_premium_transaction fct_exposure "
        "coverage_active_period coverage_month earned_exposure_month premium_earning_segments earned_premium_month "
        "priced_policy policy_exposure claim_financial_events claim_financial_state_cumulative "
        "claim_financial_state_period claim_valuation_snapshot claim_development claim_snapshot "
        "auto_exposure_attributes property_exposure_attributes fct_exposure_attribute loss_triangle "
        "loss_triangle_pooled ldf_observations claim_triangle_cumulative claim_triangle_incremental ldf_raw ldf_avg "
        "claim_triangle_versions ldf_weighted ldf_last3_weighted fct_ultimate_loss fct_ultimate_claim_count fct_selected_ultimate_loss "
        "fct_selected_ultimate_claim_count fct_frequency_severity fct_frequency_severity_trended fct_pure_premium "
        "fct_indicated_premium mart_indicated_rate_change_pure_premium mart_control_totals_financial_summary "
        "mart_control_tolerance_by_metric mart_reconciliation_by_segment mart_assumption_impact_reconciliation "
        "mart_reserve_pricing_movement_attribution mart_incurred_coverage"
    ).split()
}
MODELS["coverage_active_period_within_parents"] = lambda b: exposure.coverage_active_period(
    b.stg_policy_coverage, b.stg_policy, b.stg_policy_risk_unit, bound_by_parents=True
)
MODELS["surrogate_key"] = lambda b: b.earned_exposure_month.select(
    "coverage_id",
    "calendar_month",
    core.surrogate_key("risk_unit_id", "coverage_id", "calendar_month").alias("exposure_id"),
)
MODELS["dim_rating_factor"] = lambda b: features.dim_rating_factor(
    b.sample_assumptions.rating_factor(b.fct_exposure_attribute)
)
MODELS["dim_model_version"] = lambda b: features.dim_model_version(b.sample_assumptions.model_version())
MODELS["dim_bridge_model_version_factor"] = lambda b: features.dim_bridge_model_version_factor(
    b.sample_assumptions.bridge_model_version_factor(b.auto_exposure_attributes, b.property_exposure_attributes)
)
MODELS["loss_triangle_from_snapshot"] = lambda b: triangle.loss_triangle(b.claim_development)
MODELS["claim_triangle_from_snapshot"] = lambda b: triangle.claim_triangle_cumulative(
    b.claim_snapshot_year_end, b.priced_policy
)
for _grain in triangle.STEP_MONTHS:
    MODELS[f"loss_triangle_{_grain}"] = lambda b, g=_grain: b.loss_triangle.where(F.col("triangle_grain") == g)
for _m in MEASURES:
    MODELS[f"ldf_selected_{_m}"] = lambda b, m=_m: b.ldf_selected(m)
    MODELS[f"cdf_{_m}"] = lambda b, m=_m: b.cdf(m)
    MODELS[f"cdf_by_month_{_m}"] = lambda b, m=_m: b.cdf_by_month(m)
    MODELS[f"ultimate_{_m}_chain_ladder"] = lambda b, m=_m: b.ultimate_chain_ladder(m)

# ---- review and governance -----------------------------------------------------------


def _change_log(b: Book) -> DataFrame:
    return governance.change_log(
        b.sample_assumptions.previous_ldf_selection(),
        b.source("ldf_selection_table"),
        governance.key_columns("ldf_selection"),
        "ldf_selection-2",
        "ldf_selection",
        governance.ASSUMPTION_TYPES["ldf_selection"].file_name,
        "2002-01-01 00:00:00",
    )


def _next_versions(b: Book) -> DataFrame:
    register = b.source("assumption_version")
    return tables.concat_with_schema(
        [
            governance.next_version(register, t).select(F.lit(t).alias("assumption_type"), "*")
            for t in governance.ASSUMPTION_TYPES
        ],
        ["assumption_type", "version_sequence", "previous_assumption_set_id"],
    )


def _registered(b: Book) -> DataFrame:
    """A new version appended to the stored register, read back whole."""
    root = scratch_path(b.spark, "governance")
    register = rest.conformed(b.source("assumption_version"), "assumption_version")
    tables.append_table(register, f"{root}/assumption_version")
    row = governance.version_row(
        register, "trend_selection", "trend_selection-3", 2, 0, "actuary", "2002-02-01 00:00:00", comment="review"
    )
    tables.append_table(row, f"{root}/assumption_version")
    return tables.read_governance(b.spark, root, "assumption_version").drop("uploaded_at")


def _uploaded(b: Book) -> DataFrame:
    """Two uploads of one assumption table: register, change log and metadata as they lie there afterwards."""
    root = scratch_path(b.spark, "uploads")
    at = "2002-01-01 00:00:00"
    for df, note in ((b.sample_assumptions.previous_ldf_selection(), "first"), (b.source("ldf_selection_table"), "second")):
        governance.upload_assumption(root, "ldf_selection", df, "actuary", note, dag_id="review", uploaded_at=at)
    register, log, metadata = (
        tables.read_governance(b.spark, root, name)
        for name in ("assumption_version", "assumption_change_log", "pipeline_run_metadata")
    )
    before = register.select(
        F.col("assumption_set_id").alias("previous_assumption_set_id"), F.col("version_sequence").alias("previous_sequence")
    )
    return (
        log.select("assumption_set_id", "row_key", "change_type", "column_name", "old_value", "new_value")
        .join(register.drop("assumption_type", "file_name"), "assumption_set_id")
        .join(before, "previous_assumption_set_id", "left")
        .join(metadata.select("assumption_set_id", F.col("version_label").alias("metadata_label")), "assumption_set_id")
        .select(
            "version_sequence", "version_label", "previous_sequence", "metadata_label", "status", "uploaded_by",
            "upload_comment", "dag_id", "source_row_count", "change_count", "row_key", "change_type", "column_name",
            "old_value", "new_value",
        )
    )


def _duplicates(b: Book) -> DataFrame:
    """Keys repeated once the method is left out of the natural key."""
    keys = [k for k in governance.key_columns("selected_ultimate") if k != "METHOD"]
    return governance.duplicate_keys(b.source("selected_ultimate"), keys)


REVIEW: dict[str, Build] = {
    "review_triangles": lambda b: review.review_triangles(b.claim_triangle_cumulative, MAX_DEVELOPMENT),
    # developments and methods beyond the usual ones
    "review_triangle_cells_shifted": lambda b: review.review_triangle_cells(
        b.claim_triangle_cumulative.withColumn("development", F.col("development") + 9)
    ),
    "review_ultimate_candidates_unlisted": lambda b: review.review_ultimate_candidates(
        b.fct_ultimate_loss.unionByName(
            b.fct_ultimate_loss.where("method = 'BF'").withColumns(
                {"method": F.lit("Expected_loss"), "ultimate_loss": F.col("ultimate_loss") * 2}
            )
        ),
        b.fct_ultimate_claim_count,
    ),
    "review_ultimates": lambda b: review.review_ultimates(
        b.ultimate_chain_ladder("paid"), b.ultimate_chain_ladder("incurred"), b.ultimate_chain_ladder("claim_count")
    ),
    "ultimate_candidates_by_method": lambda b: review.ultimate_candidates_by_method(
        b.fct_ultimate_loss, b.fct_ultimate_claim_count
    ),
    "review_ultimate_candidates": lambda b: review.review_ultimate_candidates(
        b.fct_ultimate_loss, b.fct_ultimate_claim_count
    ),
    "review_frequency_severity": lambda b: review.review_frequency_severity(b.fct_frequency_severity),
    "ultimate_selection_template": lambda b: review.ultimate_selection_template(
        b.fct_ultimate_loss, b.fct_ultimate_claim_count, "v3"
    ),
    "segment_index": lambda b: review.segment_index(_segment_policies(b)),
    "normalized_values": lambda b: governance.normalized_rows(
        b.source("selected_ultimate"), governance.key_columns("selected_ultimate")
    ),
    "duplicate_keys": _duplicates,
    "upload_assumption": _uploaded,
    "change_log": lambda b: _change_log(b).drop("changed_at"),
    "change_summary": lambda b: governance.change_summary(_change_log(b)),
    "next_version": _next_versions,
    "register_version": _registered,
}

# ---- rules ------------------------------------------------------------------------


def _rated_claims(b: Book) -> DataFrame:
    """Claims with an ultimate in currency and the recovery ratio of their line."""
    auto = F.col("is_auto")
    return b.sample_raw.claim_bases().select(
        "claim_id",
        F.when(auto, "personal_auto").otherwise("commercial_property").alias("line_of_business"),
        "reported_date",
        (F.col("ultimate_cents") / 100).cast("decimal(18,2)").alias("ultimate"),
        F.when(auto, 0.05).otherwise(0.03).alias("recovery_ratio"),
    )


def _coverage_losses(b: Book) -> DataFrame:
    cover = b.stg_policy_coverage.select("coverage_id", "deductible_amount", "limit_amount")
    loss = b.sample_raw.claim_bases().select(
        "claim_id", "coverage_id", (F.col("ultimate_cents") * 7 / 100).cast("decimal(18,2)").alias("ground_up")
    )
    return loss.join(cover, "coverage_id").select(
        "claim_id",
        "ground_up",
        rules.coverage_terms(F.col("ground_up"), F.col("deductible_amount"), F.col("limit_amount")).alias("net_loss"),
    )


RULES: dict[str, Build] = {
    "coverage_term_factor": lambda b: b.stg_policy_coverage.select(
        "coverage_id",
        rules.coverage_term_factor(F.col("effective_date"), F.col("expiration_date")).alias("term_factor"),
    ),
    "invalid_terms": lambda b: rules.invalid_terms(
        # cancelled policies read as if cancelled on day one
        b.stg_policy.where("cancellation_date is not null").withColumn("expiration_date", F.col("effective_date"))
    ).select("policy_id", "effective_date", "expiration_date"),
    "risk_exposure_window": lambda b: rules.risk_exposure_window(
        b.stg_policy_risk_unit, b.stg_policy, b.params.as_of
    ),
    "severity_trend_factor": lambda b: b.stg_claim.select(
        "claim_id", rules.trend_factor(F.col("loss_date"), 0.06, BASE_YEAR).alias("trend_factor")
    ),
    "coverage_terms": _coverage_losses,
    "claim_status": lambda b: b.stg_claim.select(
        "claim_id",
        rules.claim_status(
            F.col("reported_date"), F.when(F.col("coverage_code").startswith("AUTO"), 12).otherwise(24), b.params.as_of
        ).alias("claim_status"),
    ),
    "auto_premium": lambda b: rules.auto_premium(
        b.stg_policy_coverage,
        b.stg_policy,
        b.stg_policy_risk_unit,
        b.stg_vehicle,
        b.stg_driver_vehicle_assignment,
        b.stg_driver,
        BASE_YEAR,
    ),
    "property_premium": lambda b: rules.property_premium(
        b.stg_policy_coverage, b.stg_policy, b.stg_policy_risk_unit, b.stg_property_location, BASE_YEAR
    ),
    "cancellation_refund": lambda b: rules.cancellation_refund(
        b.stg_premium_transaction, b.stg_policy_coverage, b.stg_policy
    ),
    "running_premium_balance": lambda b: rules.running_premium_balance(b.stg_premium_transaction),
    "develop_ultimates": lambda b: rules.develop_ultimates(_rated_claims(b), b.params.as_of),
    "primary_driver": lambda b: rules.primary_driver(b.stg_driver_vehicle_assignment),
    "primary_driver_contested": lambda b: rules.primary_driver(contested(b.stg_driver_vehicle_assignment)),
}

# ---- quality ------------------------------------------------------------------------


def _raw(b: Book) -> dict[str, DataFrame]:
    return {name: b.source(name) for name in quality.CONTRACT}


CONTRACTS = {
    "raw": contracts.RAW_CONTRACT,
    "assumptions": contracts.ASSUMPTION_CONTRACT,
    "governance": contracts.GOVERNANCE_CONTRACT,
    "seeds": contracts.SEED_CONTRACT,
    "core": contracts.CORE_CONTRACT,
    "exposure": contracts.EXPOSURE_CONTRACT,
    "claims": contracts.CLAIM_CONTRACT,
}


def _tables_of(b: Book, layer: str) -> dict[str, DataFrame]:
    """The tables a contract speaks of, wherever the book has them."""
    found = {name: getattr(b, f"{name}_by_coverage", getattr(b, name, None)) for name in CONTRACTS[layer]}
    return {
        name: _change_log(b) if name == "assumption_change_log" else b.source(name) if df is None else df
        for name, df in found.items()
    }


def _report(b: Book, layer: str, check: str) -> DataFrame:
    report = contracts.contract_report(_tables_of(b, layer), CONTRACTS[layer], {check})
    return report.select("table_name", "rule", "failing_rows")


def _observed_load(b: Book) -> DataFrame:
    """What a load of the perturbed premium transactions counted on its way, next to what lies there."""
    name = "raw_premium_transaction"
    path = scratch_path(b.spark, name)
    seen = contracts.observed_load(perturbed(b.source(name), name), path, contracts.RAW_CONTRACT[name])
    written = b.spark.createDataFrame(
        [(check, rule, n) for (check, rule), n in seen.items()], "check_name string, rule string, failing_rows bigint"
    )
    lies = b.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_in_table"))
    return written.join(lies)


def _range_report(b: Book) -> DataFrame:
    """Ranges of the monthly exposure, with a tight one that real months break."""
    days = b.coverage_month.select("coverage_id", "calendar_month", "active_days")
    return tables.concat_with_schema(
        [
            quality.count_failures(quality.accepted_range(days, "active_days", 1, 31), "coverage_month", "days_1_to_31"),
            quality.count_failures(quality.accepted_range(days, "active_days", 28, 31), "coverage_month", "full_months"),
            quality.count_failures(
                quality.accepted_range(days, "active_days", low=0, inclusive=False), "coverage_month", "above_zero"
            ),
        ],
        ["table_name", "rule", "failing_rows"],
    )


def _checks(b: Book) -> dict[str, tuple[str, Build]]:
    """The named checks of the pricing models: severity and failing rows."""
    t, raw = "claim_triangle_cumulative", "ldf_raw"
    checks: dict[str, tuple[str, Build]] = {
        "valuation_date_not_month_end": (
            quality.ERROR,
            lambda b: quality.not_month_end(b.claim_snapshot_year_end, "valuation_date"),
        ),
        "claim_cumulative_incurred_reconciles": (
            quality.ERROR,
            lambda b: quality.claim_cumulative_incurred_reconciles(b.claim_financial_state_cumulative),
        ),
        "claim_snapshot_population": (
            quality.ERROR,
            lambda b: quality.claim_snapshot_population(b.fct_claim, b.valuation_dates, b.claim_valuation_snapshot),
        ),
        "coverage_parent_bounds": (
            quality.ERROR,
            lambda b: quality.coverage_parent_bounds(
                b.stg_policy_coverage, b.stg_policy, b.stg_policy_risk_unit, b.coverage_active_period
            ),
        ),
        "coverage_month_reconciles": (
            quality.ERROR,
            lambda b: quality.coverage_month_reconciles(b.coverage_month, b.coverage_active_period),
        ),
        "earned_exposure_reconciles": (
            quality.ERROR,
            lambda b: quality.earned_exposure_reconciles(b.earned_exposure_month, b.coverage_month_by_unit),
        ),
        "earned_premium_reconciles_to_segments": (
            quality.ERROR,
            lambda b: quality.earned_premium_reconciles_to_segments(
                b.premium_earning_segments, b.earned_premium_month
            ),
        ),
        "earned_premium_reconciles_to_net_written": (
            quality.ERROR,
            lambda b: quality.earned_premium_reconciles_to_net_written(
                b.stg_premium_transaction, b.earned_premium_month
            ),
        ),
        "claim_snapshot_reconciles": (
            quality.ERROR,
            lambda b: quality.claim_snapshot_reconciles(
                b.claim_financial_events, b.valuation_dates, b.claim_snapshot, b.params.as_of
            ),
        ),
        "policy_exposure_within_policy_totals": (
            quality.ERROR,
            lambda b: quality.policy_exposure_within_policy_totals(b.priced_policy, b.policy_exposure),
        ),
        "policy_exposure_aggregation_consistent": (
            quality.ERROR,
            lambda b: quality.policy_exposure_aggregation_consistent(b.policy_exposure),
        ),
        "earned_premium_within_written": (
            quality.ERROR,
            lambda b: quality.earned_premium_within_written(b.priced_policy, b.policy_exposure),
        ),
        "policy_exposure_not_negative": (
            quality.ERROR,
            lambda b: quality.policy_exposure_not_negative(b.policy_exposure),
        ),
        "triangle_reconciles_to_snapshot": (
            quality.ERROR,
            lambda b: quality.triangle_reconciles_to_snapshot(
                b.claim_snapshot_year_end, b.priced_policy, b.claim_triangle_cumulative
            ),
        ),
        "triangle_paid_not_decreasing": (
            quality.ERROR,
            lambda b: quality.triangle_paid_not_decreasing(getattr(b, t)),
        ),
        "triangle_incurred_not_collapsing": (
            quality.WARN,
            lambda b: quality.triangle_incurred_not_collapsing(getattr(b, t)),
        ),
        "paid_link_ratios_at_least_one": (
            quality.ERROR,
            lambda b: quality.link_ratio_share_at_least_one(getattr(b, raw), "link_ratio_paid", 1.0),
        ),
        "incurred_link_ratios_at_least_one": (
            quality.WARN,
            lambda b: quality.link_ratio_share_at_least_one(getattr(b, raw), "link_ratio_incurred", 0.9),
        ),
        "last3_defaults_to_one": (
            quality.ERROR,
            lambda b: quality.last3_defaults_to_one(getattr(b, t), b.ldf_last3_weighted),
        ),
        "selected_method_loss_coverage": (
            quality.ERROR,
            lambda b: quality.selection_missing(b.fct_ultimate_loss, b.stg_ultimate_selection_loss),
        ),
        "selected_method_claim_count_coverage": (
            quality.ERROR,
            lambda b: quality.selection_missing(b.fct_ultimate_claim_count, b.stg_ultimate_selection_claim_count),
        ),
    }
    for m in MEASURES:
        severity = quality.WARN if m == "incurred" else quality.ERROR
        value = "ultimate_claim_count" if m == "claim_count" else "ultimate_loss"
        floor = "cumulative_claim_count" if m == "claim_count" else "cumulative_paid"
        checks[f"selected_ldf_coverage_{m}"] = (
            quality.ERROR,
            lambda b, m=m: quality.selected_ldf_coverage(b.ldf_raw, b.ldf_selected(m), m),
        )
        checks[f"ldf_not_positive_{m}"] = (
            quality.ERROR,
            lambda b, m=m: quality.ldf_not_positive(b.ldf_selected(m), m),
        )
        checks[f"cdf_below_one_{m}"] = (severity, lambda b, m=m: quality.cdf_below_one(b.cdf(m)))
        checks[f"cdf_rising_{m}"] = (severity, lambda b, m=m: quality.cdf_rising(b.cdf(m)))
        checks[f"ultimate_equals_latest_{m}"] = (
            quality.ERROR,
            lambda b, m=m: quality.ultimate_equals_latest_at_unit_cdf(
                b.ultimate_chain_ladder(m), b.claim_triangle_cumulative, b.cdf_by_month(m), m
            ),
        )
        checks[f"ultimate_below_latest_{m}"] = (
            quality.ERROR,
            lambda b, m=m, v=value, f=floor: quality.ultimate_below_latest(
                b.ultimate_chain_ladder(m), b.claim_triangle_cumulative, v, f
            ),
        )
    return checks


def quality_report(b: Book) -> DataFrame:
    """Every named check, one after the other: together their plans would be one of some hundred joins."""
    return quality.quality_report({name: (severity, build(b)) for name, (severity, build) in _checks(b).items()})


QUALITY: dict[str, Build] = {
    "not_null_report": lambda b: quality.not_null_report(_raw(b)),
    "unique_report": lambda b: _report(b, "raw", "unique"),
    "accepted_values_report": lambda b: quality.accepted_values_report(_raw(b)),
    "relationships_report": lambda b: _report(b, "raw", "relationships"),
    "expression_report": lambda b: quality.expression_report(_raw(b)),
    "unique_combination_report": lambda b: _report(b, "raw", "unique_combination"),
    "accepted_range_report": _range_report,
    "effective_date_valid": lambda b: quality.effective_date_valid(
        b.stg_policy, "effective_date", b.params.as_of, CHECK_FROM
    ).select("policy_id", "effective_date"),
    "quality_report": quality_report,
    # rules the raw tables really break, so that failing rows are compared too
    "month_end_failures": lambda b: quality.not_month_end(b.stg_policy, "effective_date").select(
        "policy_id", "effective_date"
    ),
    "not_null_failures": lambda b: quality.not_null(b.stg_policy, "cancellation_date").select("policy_id"),
    "unique_failures": lambda b: quality.unique(b.stg_premium_transaction, "coverage_id"),
    "accepted_values_failures": lambda b: quality.accepted_values(
        b.stg_policy, "underwriting_tier", ["preferred", "standard", "nonstandard", "commercial", "ALL"]
    ).select("policy_id", "underwriting_tier"),
    "relationships_failures": lambda b: quality.relationships(
        b.stg_policy_coverage, "coverage_id", b.stg_claim, "coverage_id"
    ).withColumnRenamed("key", "coverage_id"),
    "expression_failures": lambda b: quality.expression_is_true(
        b.stg_premium_transaction, "premium_change >= 0"
    ).select("transaction_id", "premium_change"),
}
QUALITY.update({name: build for name, (_, build) in _checks(None).items()})
QUALITY.update({f"contract_report_{k}": lambda b, k=k: contracts.contract_report(_tables_of(b, k), CONTRACTS[k]) for k in CONTRACTS})
QUALITY["contract_report_raw_perturbed"] = lambda b: contracts.contract_report(
    {name: perturbed(df, name) for name, df in _raw(b).items()}, contracts.RAW_CONTRACT
)
QUALITY["observed_load_report"] = _observed_load
QUALITY["state_period_faults"] = lambda b: quality.state_period_faults(b.claim_financial_state_period)
QUALITY["state_period_faults_perturbed"] = lambda b: quality.state_period_faults(
    perturbed(b.claim_financial_state_period, "claim_financial_state_period")
)

# every check once more on an input that breaks it
QUALITY.update(
    {f"{name}_faulty": lambda b, n=name, f=fault: _checks(None)[n][1](Faulty(b, f)) for name, fault in FAULTS.items()}
)

BUILDS: dict[str, Build] = {
    **SOURCES, **STAGING, **CALENDAR, **MODELS, **REVIEW, **RULES, **QUALITY,
}

# the pricing chain, its controls and checks at a valuation that is no year end
MID_YEAR = (
    "valuation_dates claim_triangle_cumulative claim_triangle_from_snapshot claim_triangle_incremental "
    "ldf_raw ldf_avg ldf_weighted ldf_last3_weighted ldf_selected_paid ldf_selected_incurred ldf_selected_claim_count "
    "cdf_paid cdf_incurred cdf_claim_count cdf_by_month_paid cdf_by_month_incurred cdf_by_month_claim_count "
    "ultimate_paid_chain_ladder ultimate_incurred_chain_ladder ultimate_claim_count_chain_ladder "
    "fct_ultimate_loss fct_ultimate_claim_count fct_selected_ultimate_loss fct_selected_ultimate_claim_count "
    "fct_frequency_severity fct_pure_premium fct_indicated_premium mart_indicated_rate_change_pure_premium "
    "mart_control_totals_financial_summary mart_control_tolerance_by_metric mart_reconciliation_by_segment "
    "triangle_reconciles_to_snapshot triangle_paid_not_decreasing ultimate_below_latest_paid"
).split()


# the same results from tables at rest
AT_REST = "earned_premium_month claim_triangle_cumulative mart_indicated_rate_change_pure_premium policy_exposure".split()
_resting: dict[tuple, Book] = {}


def resting_book(spark: SparkSession, sf_dir: str) -> Book:
    """The lineage of a directory over tables written at rest once in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _resting:
        root = scratch_path(spark, "at_rest")
        write_sample(spark, sf_dir, root, QUERY_PARAMS)
        _resting[key] = resting_sample(spark, sf_dir, root, QUERY_PARAMS)
    return _resting[key]


def build_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def sized(run):
        return lambda spark, sf_dir: run(size_to(spark, sample_shuffles(spark, sf_dir)), sf_dir)

    def query(build: Build, **changes):
        return sized(lambda spark, sf_dir: present(build(book_for(spark, sf_dir, **changes))))

    queries = {name: query(build) for name, build in BUILDS.items()}
    queries["policy_exposure_v1"] = query(BUILDS["policy_exposure"], segmentation_version="v1")
    queries["claim_triangle_cumulative_v1"] = query(
        lambda b: b.claim_triangle_versions.where("segmentation_version = 'v1'").drop("segmentation_version")
    )
    for name in MID_YEAR:
        queries[f"{name}_mid_year"] = query(BUILDS[name], as_of=date(2001, 6, 30))
    for name in AT_REST:
        queries[f"{name}_at_rest"] = sized(lambda spark, sf_dir, n=name: present(BUILDS[n](resting_book(spark, sf_dir))))
    queries["assumption_impact_without_baseline"] = query(
        BUILDS["mart_assumption_impact_reconciliation"], baseline_loss_method="Chain_ladder"
    )
    return queries
