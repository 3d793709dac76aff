"""Staging: the columns of each source that later steps rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SEGMENT_NAMES = {"state": "state_grp", "risk_class": "risk_class_grp", "vehicle_segment": "vehicle_segment_grp"}


def _project(df: DataFrame, columns: str, renames: dict[str, str] | None = None) -> DataFrame:
    renames = renames or {}
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in columns.split()])


def stg_policy(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "policy_id policy_number insured_id product_id line_of_business effective_date expiration_date "
        "cancellation_date status underwriting_tier primary_state term_months source_system",
        {"status": "policy_status"},
    )


def stg_policy_risk_unit(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "risk_unit_id policy_id risk_unit_type source_risk_unit_id effective_date expiration_date status "
        "exposure_unit source_system",
        {"status": "policy_risk_unit_status"},
    )


def stg_policy_coverage(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "coverage_id policy_id risk_unit_id coverage_code coverage_family effective_date expiration_date "
        "limit_amount deductible_amount written_premium source_system",
    )


def stg_premium_transaction(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "transaction_id policy_id coverage_id transaction_type transaction_date transaction_reason "
        "premium_change cumulative_premium source_system",
    )


def stg_claim(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "claim_id policy_id risk_unit_id coverage_id coverage_code loss_date reported_date claim_type "
        "cause_code claim_status source_system",
    )


def stg_claim_transaction(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "transaction_id claim_id transaction_type transaction_date paid_loss_change case_reserve_change "
        "paid_expense_change case_expense_change recovery_change incurred_loss_change source_system",
    )


def stg_vehicle(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "vehicle_id policy_id vehicle_sequence model_year make model vehicle_type garaging_state "
        "annual_mileage usage safety_device_flag source_system",
    )


def stg_driver(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "driver_id policy_id driver_sequence date_of_birth gender years_licensed prior_accidents "
        "prior_violations marital_status credit_tier source_system",
    )


def stg_driver_vehicle_assignment(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "assignment_id policy_id driver_id vehicle_id assignment_type effective_date expiration_date source_system",
    )


def stg_property_location(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "location_id policy_id location_sequence state zip_code occupancy construction_type year_built "
        "protection_class total_insured_value source_system",
    )


def stg_ldf_selection_table(src: DataFrame, version: str = "v3") -> DataFrame:
    return _project(
        src.where(F.col("segmentation_version") == version),
        "segmentation_version triangle_type state risk_class vehicle_segment development ldf method description",
        _SEGMENT_NAMES,
    )


def _one_type(src: DataFrame, kind: str, version: str) -> DataFrame:
    return src.where((F.col("type") == kind) & (F.col("segmentation_version") == version))


def _stg_selected_ultimate(src: DataFrame, kind: str, version: str) -> DataFrame:
    return _project(
        _one_type(src, kind, version),
        "segmentation_version state risk_class vehicle_segment accident_year ultimate method comment",
        {**_SEGMENT_NAMES, "ultimate": f"ultimate_{kind}"},
    )


def stg_selected_ultimate_loss(src: DataFrame, version: str = "v3") -> DataFrame:
    return _stg_selected_ultimate(src, "loss", version)


def stg_selected_ultimate_claim_count(src: DataFrame, version: str = "v3") -> DataFrame:
    return _stg_selected_ultimate(src, "claim_count", version)


def _stg_ultimate_selection(src: DataFrame, kind: str, version: str) -> DataFrame:
    return _project(
        _one_type(src, kind, version),
        "segmentation_version state risk_class vehicle_segment accident_year method comment",
        {**_SEGMENT_NAMES, "method": "selected_method"},
    )


def stg_ultimate_selection_loss(src: DataFrame, version: str = "v3") -> DataFrame:
    return _stg_ultimate_selection(src, "loss", version)


def stg_ultimate_selection_claim_count(src: DataFrame, version: str = "v3") -> DataFrame:
    return _stg_ultimate_selection(src, "claim_count", version)


def stg_trend_selection(src: DataFrame, version: str = "v3") -> DataFrame:
    return _project(
        src.where(F.col("segmentation_version") == version),
        "segmentation_version trend_type state risk_class vehicle_segment annual_trend effective_from "
        "effective_to description",
        _SEGMENT_NAMES,
    )


def stg_expense_assumption(src: DataFrame) -> DataFrame:
    return _project(
        src,
        "pricing_version state fixed_expense_per_exposure variable_expense_ratio ulae_ratio profit_ratio "
        "target_loss_ratio",
        _SEGMENT_NAMES,
    )


def stg_rate_level_history(src: DataFrame) -> DataFrame:
    return _project(
        src,
        "filing_id effective_date state risk_class vehicle_segment rate_change_pct cumulative_factor",
        _SEGMENT_NAMES,
    )


def stg_assumption_version(src: DataFrame) -> DataFrame:
    return _project(
        src,
        "assumption_set_id assumption_type file_name target_table_name version_sequence version_label status "
        "uploaded_at uploaded_by upload_comment source_row_count change_count previous_assumption_set_id "
        "dag_id dag_run_id task_id",
    )


def stg_assumption_change_log(src: DataFrame) -> DataFrame:
    return _project(
        src,
        "assumption_set_id assumption_type file_name row_key change_type column_name old_value new_value changed_at",
    )


def stg_pipeline_run_metadata(src: DataFrame) -> DataFrame:
    return _project(
        src,
        "pipeline_run_metadata_id dag_id dag_run_id task_id assumption_set_id assumption_type file_name "
        "version_sequence version_label registered_at",
    )
