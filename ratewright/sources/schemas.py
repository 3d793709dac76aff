"""Declared schemas of the input tables.

Each raw table carries two audit columns at the end. Identifiers are strings by
contract; operators do not depend on that, so integer keys work too.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "decimal(18,2)": T.DecimalType(18, 2),
}
_AUDIT = "load_batch_id string, ingested_at timestamp"


def _table(columns: str) -> T.StructType:
    """A schema from ``name type, name type``; needs no running session."""
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _raw(columns: str) -> T.StructType:
    return _table(f"{columns}, source_system string, {_AUDIT}")


RAW = {
    "raw_policy": _raw(
        "policy_id string, policy_number string, insured_id string, product_id string, line_of_business string, "
        "effective_date date, expiration_date date, cancellation_date date, status string, "
        "underwriting_tier string, primary_state string, term_months int"
    ),
    "raw_policy_risk_unit": _raw(
        "risk_unit_id string, policy_id string, risk_unit_type string, source_risk_unit_id string, "
        "effective_date date, expiration_date date, status string, exposure_unit string"
    ),
    "raw_policy_coverage": _raw(
        "coverage_id string, policy_id string, risk_unit_id string, coverage_code string, coverage_family string, "
        "effective_date date, expiration_date date, limit_amount decimal(18,2), deductible_amount decimal(18,2), "
        "written_premium decimal(18,2)"
    ),
    "raw_premium_transaction": _raw(
        "transaction_id string, policy_id string, coverage_id string, transaction_type string, "
        "transaction_date date, transaction_reason string, premium_change decimal(18,2), "
        "cumulative_premium decimal(18,2)"
    ),
    "raw_claim": _raw(
        "claim_id string, policy_id string, risk_unit_id string, coverage_id string, coverage_code string, "
        "loss_date date, reported_date date, claim_type string, cause_code string, claim_status string"
    ),
    "raw_claim_transaction": _raw(
        "transaction_id string, claim_id string, transaction_type string, transaction_date date, "
        "paid_loss_change decimal(18,2), case_reserve_change decimal(18,2), paid_expense_change decimal(18,2), "
        "case_expense_change decimal(18,2), recovery_change decimal(18,2), incurred_loss_change decimal(18,2)"
    ),
    "raw_vehicle": _raw(
        "vehicle_id string, policy_id string, vehicle_sequence int, model_year int, make string, model string, "
        "vehicle_type string, garaging_state string, annual_mileage int, usage string, safety_device_flag int"
    ),
    "raw_driver": _raw(
        "driver_id string, policy_id string, driver_sequence int, date_of_birth date, gender string, "
        "years_licensed int, prior_accidents int, prior_violations int, marital_status string, credit_tier string"
    ),
    "raw_driver_vehicle_assignment": _raw(
        "assignment_id string, policy_id string, driver_id string, vehicle_id string, assignment_type string, "
        "effective_date date, expiration_date date"
    ),
    "raw_property_location": _raw(
        "location_id string, policy_id string, location_sequence int, state string, zip_code string, "
        "occupancy string, construction_type string, year_built int, protection_class int, "
        "total_insured_value decimal(18,2)"
    ),
    "rate_level_history": _table(
        "filing_id string, effective_date date, state string, risk_class string, vehicle_segment string, "
        "rate_change_pct double, cumulative_factor double"
    ),
}

ASSUMPTIONS = {
    "ldf_selection_table": _table(
        "segmentation_version string, triangle_type string, state string, risk_class string, "
        "vehicle_segment string, development int, ldf double, method string, description string"
    ),
    "selected_ultimate": _table(
        "segmentation_version string, type string, state string, risk_class string, vehicle_segment string, "
        "accident_year int, method string, ultimate double, comment string"
    ),
    "ultimate_selection": _table(
        "segmentation_version string, type string, state string, risk_class string, vehicle_segment string, "
        "accident_year int, method string, comment string"
    ),
    "trend_selection": _table(
        "segmentation_version string, trend_type string, state string, risk_class string, vehicle_segment string, "
        "annual_trend double, effective_from date, effective_to date, description string"
    ),
    "expense_assumption": _table(
        "pricing_version string, state string, fixed_expense_per_exposure double, variable_expense_ratio double, "
        "ulae_ratio double, profit_ratio double, target_loss_ratio double"
    ),
}

GOVERNANCE = {
    "assumption_version": _table(
        "assumption_set_id string, assumption_type string, file_name string, target_table_name string, "
        "version_sequence bigint, version_label string, status string, uploaded_at timestamp, uploaded_by string, "
        "upload_comment string, source_row_count bigint, change_count bigint, previous_assumption_set_id string, "
        "dag_id string, dag_run_id string, task_id string"
    ),
    "assumption_change_log": _table(
        "assumption_set_id string, assumption_type string, file_name string, row_key string, change_type string, "
        "column_name string, old_value string, new_value string, changed_at timestamp"
    ),
    "pipeline_run_metadata": _table(
        "pipeline_run_metadata_id string, dag_id string, dag_run_id string, task_id string, "
        "assumption_set_id string, assumption_type string, file_name string, version_sequence bigint, "
        "version_label string, registered_at timestamp"
    ),
}

SEEDS = {
    "development_pool_mapping": _table(
        "development_pool_id string, pool_level string, line_of_business string, product_id string, "
        "coverage_code string"
    ),
    "rating_factor": _table(
        "factor_id string, factor_name string, entity_level string, data_type string, description string"
    ),
    "model_version": _table(
        "model_version_id string, product_id string, line_of_business string, version_number int, "
        "effective_start_date date, effective_end_date date, status string"
    ),
    "bridge_model_version_factor": _table(
        "model_version_id string, factor_id string, transformation_id string, required_flag int"
    ),
}

ALL = {**RAW, **ASSUMPTIONS, **GOVERNANCE, **SEEDS}
